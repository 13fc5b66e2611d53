"""Files -> documents -> chunks -> vectors, with failures kept per file."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions.maps import record_map
from docweave.functions.names import collection_of, log_time, namespace_of, stable_uuid
from docweave.operators.chunking import chunks_of
from docweave.operators.embedding import DIMENSION, embedder
from docweave.operators.reports import observed_outcomes
from docweave.schemas import DEFAULT_NAMESPACE, FILE_METADATA
from docweave.session import spread, stage
from docweave.sources.files import attach_bytes, file_documents, load_documents, stored_documents

# How a category names the place its vectors go to.
TARGETS = {"namespace": namespace_of, "collection": collection_of}


@dataclass
class FileEtl:
    """`vectors` to write; `outcomes`, one row per file: file_id, category,
    full_path, documents, chunks, stage and error (null when the file went well);
    `stored`, one row per document of a good file: full_path, doc_no, namespace and
    chunks, which give its chunk ids; `places`, the namespaces written to; `counts`, the
    numbers of files that went well and that failed (see `reports.observed_outcomes`)."""

    vectors: DataFrame
    outcomes: DataFrame
    stored: DataFrame
    counts: dict

    @property
    def places(self) -> DataFrame:
        return self.stored.select(F.col("namespace").alias("name")).distinct()


REPEATED_PATH = "path is listed more than once"


def one_row_per_path(files: DataFrame):
    """(files, one row per path; the other rows that name a path again).

    Paths are counted without the rest of the rows; only rows whose path repeats are
    sorted, and the smallest file_id is kept. Rows with its id too are dropped.
    """
    repeated = (files.groupBy(F.col("full_path").alias("_path")).agg(F.count(F.lit(1)).alias("_n"))
                .where("_n > 1 and _path is not null").select("_path"))
    same = F.col("full_path") == F.col("_path")
    turn = F.row_number().over(Window.partitionBy("full_path").orderBy("file_id"))
    first_id = F.min("file_id").over(Window.partitionBy("full_path"))
    several = files.join(repeated, same, "left_semi").withColumns({"_turn": turn, "_first": first_id})
    kept = files.join(repeated, same, "left_anti").unionByName(several.where("_turn = 1").drop("_turn", "_first"))
    others = several.where("_turn > 1 and not file_id <=> _first").drop("_turn", "_first")
    return kept, others


def rejected_documents(files: DataFrame, reason) -> DataFrame:
    """`files` as documents that were not read, with a reason."""
    return files.select(*FILE_METADATA.names, F.lit(0).alias("doc_no"),
                        F.lit(None).cast("string").alias("content"), reason.alias("error"))


def process_files(files: DataFrame, extractors=None, **options) -> FileEtl:
    """`files` has the file metadata columns and `body` (see `attach_bytes`); options
    as for `process_documents`."""
    files, again = one_row_per_path(files.select(*FILE_METADATA.names, "body"))
    documents = file_documents(files, extractors).unionByName(rejected_documents(again, F.lit(REPEATED_PATH)))
    return process_documents(documents, **options)


def run_file_etl(files: DataFrame, root: str, extractors=None, invalid=None, **options) -> FileEtl:
    """`process_files` on files stored under `root`. `invalid` are records (with
    `violations`, see `quality.split_by_validity`) that only become failure rows."""
    kept, again = one_row_per_path(files.select(*FILE_METADATA.names))
    located = attach_bytes(kept, root, csv_apart=True)
    documents = stored_documents(
        located.select(*FILE_METADATA.names, "location", "body_bytes", "body"), extractors)
    documents = documents.unionByName(rejected_documents(again, F.lit(REPEATED_PATH)))
    if invalid is not None:
        broken = F.concat(F.lit("broken rules: "), F.concat_ws(", ", "violations"))
        documents = documents.unionByName(rejected_documents(invalid, broken))
    return process_documents(documents, **options)


def load_vectors(spark: SparkSession, where, namespace=None, extractors=None, glob=None, **options) -> FileEtl:
    """Files under a folder, or of a list of paths, to vectors of one namespace,
    without a catalogue: the path serves as file id, and no other metadata is known."""
    documents = load_documents(spark, where, extractors, glob)
    known = {"file_id": F.col("metadata")["source"], "full_path": F.col("metadata")["source"],
             "category": F.lit(namespace)}
    columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FILE_METADATA.fields]
    rows = documents.select(*columns, F.col("metadata")["row"].cast("bigint").alias("doc_no"), "content", "error")
    return process_documents(rows, place=F.col("category"), **options)


def process_documents(documents: DataFrame, model_factory=None, dim=DIMENSION, splitter=None,
                      target="namespace", batch_size=1024, place=None) -> FileEtl:
    """Documents of files (file metadata, doc_no, content, error) to vectors.

    One plan over all files: a file that cannot be read, split or embedded gives
    a failure row and no vectors, and does not disturb the others. The result of
    the Python steps is written once and then divided. A file without category goes
    to the default namespace; `place` names another one than the category does.
    """
    place = TARGETS[target](F.col("category")) if place is None else place
    place = F.when(F.coalesce(place, F.lit("")) == "", DEFAULT_NAMESPACE).otherwise(place)
    with_chunks = documents.withColumn("_pieces", chunks_of(splitter)(F.col("content")))
    # Outer: a file without any chunk must stay visible.
    pieces = with_chunks.select(
        *FILE_METADATA.names, "doc_no", F.col("error").alias("read_error"),
        F.posexplode_outer("_pieces").alias("chunk_no", "_piece"))
    # Chunks, not files, are shared out: a file with most of the text is embedded
    # by many tasks.
    pieces = spread(pieces, "full_path", "doc_no", "chunk_no")
    embedded = pieces.withColumn("_vector", embedder(model_factory, dim, batch_size)(F.col("_piece.text")))

    has_text = F.col("_piece.text").isNotNull()
    split_error, embed_error = F.col("_piece.error"), F.when(has_text, F.col("_vector.error"))
    failed_at = (F.when(F.col("read_error").isNotNull(), "read")
                 .when(split_error.isNotNull(), "split")
                 .when(embed_error.isNotNull(), "embed"))
    dated = {f.name: log_time(F.col(f.name)) for f in FILE_METADATA.fields
             if documents.schema[f.name].dataType == T.TimestampType()}
    source = F.create_map(F.lit("source"), F.col("full_path"), F.lit("document"), F.col("doc_no").cast("string"))
    rows = stage(embedded.select(
        "file_id", "category", "full_path", "doc_no", "chunk_no",
        chunk_key(F.col("full_path"), F.col("doc_no"), F.col("chunk_no")).alias("id"),
        F.col("_vector.embedding").alias("embedding"), F.col("_piece.text").alias("content"),
        F.map_concat(F.map_filter(record_map(*FILE_METADATA.names, **dated), lambda _, v: v.isNotNull()), source)
        .alias("metadata"),
        place.alias("namespace"), failed_at.alias("stage"),
        F.coalesce("read_error", split_error, embed_error).alias("error")), "file-etl")

    per_file = rows.groupBy("file_id", "category", "full_path", "namespace").agg(
        (F.max("doc_no") + 1).cast("bigint").alias("documents"), F.count("content").alias("chunks"),
        F.min(F.when(F.col("error").isNotNull(), F.struct("stage", "error"))).alias("_worst"))
    blank = F.col("_worst").isNull() & (F.col("chunks") == 0)
    files_done, seen = observed_outcomes(per_file.select(
        "file_id", "category", "full_path", "namespace", "documents", "chunks",
        F.when(blank, "split").otherwise(F.col("_worst.stage")).alias("stage"),
        F.when(blank, "no text in file").otherwise(F.col("_worst.error")).alias("error")))
    files_done = stage(files_done, "outcomes")

    # Written apart, so that its true (small) size decides the join below.
    failed = stage(files_done.where("error is not null").select(
        F.col("file_id").alias("_file"), F.col("full_path").alias("_path")), "failed-files")
    good = rows.where("error is null and content is not null").join(
        failed, F.col("file_id").eqNullSafe(F.col("_file")) & F.col("full_path").eqNullSafe(F.col("_path")), "left_anti")
    vectors = good.select("id", "embedding", "content", "metadata", "namespace")
    stored = good.groupBy("full_path", F.col("doc_no").cast("bigint").alias("doc_no"), "namespace").agg(
        F.count(F.lit(1)).alias("chunks"))
    return FileEtl(
        vectors, files_done.select("file_id", "category", "full_path", "documents", "chunks", "stage", "error"),
        stored, seen.get)


def chunk_key(path, doc_no, chunk_no):
    """Id of a chunk: the same whenever the same file is read again."""
    return stable_uuid(path, doc_no.cast("string"), chunk_no.cast("string"))


def replaced_chunks(stored_before: DataFrame, stored_now: DataFrame) -> DataFrame:
    """Keys of the chunks that files had before which are now read again.

    Made from the `stored` rows alone, one key per chunk: the vector table is not read.
    """
    again = stored_before.join(stored_now.select("full_path"), "full_path", "left_semi")
    chunks = again.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)).alias("_chunk"))
    return chunks.select("namespace", chunk_key(F.col("full_path"), F.col("doc_no"), F.col("_chunk")).alias("id"))
