"""Text to vector, with a pluggable model."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators.selection import require_positive

# Fixed value: vector length of the default index.
DIMENSION = 1536
# Words whose buckets a task remembers.
MAX_WORDS = 100_000


class _Buckets(dict):
    """Buckets of the words seen so far, forgotten when they become too many."""

    def __init__(self, dim):
        super().__init__()
        self.dim = dim

    def __missing__(self, word):
        if len(self) >= MAX_WORDS:
            self.clear()
        place = self[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dim
        return place


def hashing_model(dim=DIMENSION):
    """Model factory of the offline default: a hashed bag of words.

    Lower case, tokens `[a-z0-9]+`, bucket = first 8 hex digits of md5(token)
    mod `dim`, counts scaled to unit length. It compares words, not meaning: a
    stand-in where no language model is available.
    """
    require_positive(dim, "dimension")

    def factory():
        # Every byte outside [a-z0-9] ends a word; characters outside ASCII
        # arrive as '?', so they do too.
        word_bytes = bytes(b if chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for b in range(256))
        bucket_of = _Buckets(dim).__getitem__

        def model(texts):
            plain = [text.lower().encode("ascii", "replace").translate(word_bytes) for text in texts]
            words = pc.ascii_split_whitespace(pa.array(plain, pa.binary()).cast(pa.string()))
            row = np.repeat(np.arange(len(texts)), words.value_lengths().to_numpy())
            coded = words.flatten().dictionary_encode()
            # Blanks at the ends of a text give empty words.
            bucket = np.fromiter((bucket_of(word) if word else -1 for word in coded.dictionary.to_pylist()),
                                 "int64", len(coded.dictionary))[coded.indices.to_numpy()]
            found = bucket >= 0
            rows = np.bincount(row[found] * dim + bucket[found], minlength=len(texts) * dim)
            rows = rows.reshape(len(texts), dim).astype("float64")
            norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
            return np.divide(rows, norms, out=rows, where=norms > 0)

        return model

    return factory


def _checked(values, count, dim):
    values = np.asarray(values, dtype="float32")
    if values.shape != (count, dim):
        raise ValueError(f"the model returned shape {values.shape}, expected {(count, dim)}")
    return values


def embedder(model_factory=None, dim=DIMENSION, batch_size=1024):
    """Column function: text -> struct<embedding, error>.

    `model_factory()` is called once per Python worker task and returns a
    callable `list[str] -> array of shape (n, dim)`. If it fails on a batch, the
    texts of the batch are tried one by one and only the failing ones get an error.
    """
    require_positive(dim, "dimension")
    require_positive(batch_size, "batch size")
    make = model_factory or hashing_model(dim)

    def one_by_one(model, texts):
        values, errors = np.zeros((len(texts), dim), "float32"), []
        for i, text in enumerate(texts):
            try:
                values[i] = _checked(model([text]), 1, dim)[0]
                errors.append(None)
            except Exception as failure:  # noqa: BLE001 - becomes a failure row
                errors.append(f"{type(failure).__name__}: {failure}")
        return values, errors

    def run(model, texts):
        values, errors = [np.zeros((0, dim), "float32")], []
        for start in range(0, len(texts), batch_size):
            part = texts[start:start + batch_size]
            try:
                got, failed = _checked(model(part), len(part), dim), [None] * len(part)
            except Exception:  # noqa: BLE001 - isolate the failing texts
                got, failed = one_by_one(model, part)
            values.append(got)
            errors.extend(failed)
        return np.concatenate(values), errors

    def one(model, batch):
        texts = batch.to_pylist()
        present = [i for i, text in enumerate(texts) if text is not None]
        values, errors = run(model, [texts[i] for i in present])
        all_errors = ["text is null"] * len(texts)
        for i, error in zip(present, errors):
            all_errors[i] = error
        failed = np.array([error is not None for error in all_errors], dtype=bool)
        rows = np.zeros((len(texts), dim), "float32")
        rows[present] = values
        offsets = pa.array(np.arange(len(texts) + 1, dtype="int32") * dim)
        vectors = pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1)), mask=pa.array(failed))
        return pa.StructArray.from_arrays([vectors, pa.array(all_errors, pa.string())], names=["embedding", "error"])

    @F.arrow_udf("struct<embedding:array<float>,error:string>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = make()
        for batch in batches:
            # Piece by piece: only one piece of a batch is held as Python texts.
            parts = [one(model, batch.slice(start, batch_size)) for start in range(0, len(batch), batch_size)]
            yield pa.concat_arrays(parts) if parts else one(model, batch)

    # Keeps Catalyst from copying the call into a filter and running it twice.
    return embed.asNondeterministic()


def embed_rows(rows: DataFrame, text: str, model_factory=None, dim=DIMENSION, batch_size=1024) -> DataFrame:
    """Adds `embedding` and `embedding_error`.

    Narrow; `session.spread` the rows first where the model costs more than
    moving the text.
    """
    embed = embedder(model_factory, dim, batch_size)
    return (rows.withColumn("_vector", embed(F.col(text)))
            .withColumn("embedding", F.col("_vector.embedding"))
            .withColumn("embedding_error", F.col("_vector.error")).drop("_vector"))


def embed_text(text, model_factory=None, dim=DIMENSION):
    """The vector of one query text, computed on the driver."""
    model = (model_factory or hashing_model(dim))()
    return [float(x) for x in _checked(model([text]), 1, dim)[0]]
