"""Recursive text splitting."""

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.names import stable_uuid
from docweave.operators.selection import require_positive

# Default chunk size and overlap in characters, and the break
# points from the widest to the narrowest; below them a text breaks anywhere.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 0
SEPARATORS = ("\n\n", "\n", " ")


def text_splitter(size=CHUNK_SIZE, overlap=CHUNK_OVERLAP, separators=SEPARATORS):
    """A function `text -> list of chunks`.

    A separator belongs to the piece it opens. Neighbouring pieces are joined
    while they fit in `size`; a piece that is too long itself is cut at the next
    narrower separator, and its chunks are not joined with its neighbours.
    """
    require_positive(size, "chunk size")
    if overlap < 0 or overlap >= size:
        raise ValueError("chunk overlap must be at least 0 and less than the chunk size")
    openings = [re.compile(re.escape(s)) for s in separators]

    def edges_of(text, lo, hi, level):
        """Piece boundaries of text[lo:hi], both ends included."""
        return [lo, *(m.start() for m in openings[level].finditer(text, lo, hi) if m.start() > lo), hi]

    def pack(text, edges, out):
        """Join neighbouring pieces, each at most `size` long, into chunks."""
        first, last = 0, len(edges) - 1
        while first < last:
            end = max(bisect_right(edges, edges[first] + size, first + 1) - 1, first + 1)
            out.append(text[edges[first]:edges[end]])
            if end == last:
                return
            # Step back over trailing pieces that fit in the overlap and still
            # leave room for the next piece.
            first, following = end, edges[end + 1] - edges[end]
            while overlap and edges[end] - edges[first - 1] <= min(overlap, size - following):
                first -= 1

    def cut_anywhere(text, lo, hi, out):
        for start in range(lo, max(hi - overlap, lo + 1), size - overlap):
            out.append(text[start:min(start + size, hi)])

    def cut_by_mark(text, lo, hi, level, out):
        """Without overlap and with a one-character separator, each chunk ends at the
        last separator in reach: no need to look at every piece."""
        mark = separators[level]
        while hi - lo > size:
            end = text.rfind(mark, lo + 1, lo + size + 1)
            if end < 0:
                end = text.find(mark, lo + size + 1, hi)
                end = hi if end < 0 else end
                split(text, lo, end, level + 1, out)
            else:
                out.append(text[lo:end])
            lo = end
        if lo < hi:
            out.append(text[lo:hi])

    def split(text, lo, hi, level, out):
        if hi - lo <= size:
            out.append(text[lo:hi])
        elif level == len(separators):
            cut_anywhere(text, lo, hi, out)
        elif not overlap and len(separators[level]) == 1:
            cut_by_mark(text, lo, hi, level, out)
        else:
            edges, run = edges_of(text, lo, hi, level), 0
            for i, (start, end) in enumerate(zip(edges, edges[1:])):
                if end - start > size:
                    pack(text, edges[run:i + 1], out)
                    split(text, start, end, level + 1, out)
                    run = i + 1
            pack(text, edges[run:], out)

    def splitter(text):
        raw = []
        split(text, 0, len(text), 0, raw)
        return [chunk for chunk in map(str.strip, raw) if chunk]

    return splitter


def chunks_of(splitter=None):
    """Column function: text -> array<struct<text, error>>.

    A text the splitter fails on gives one element with the error, so that one
    document cannot fail the job.
    """
    cut = splitter or text_splitter()

    @F.arrow_udf("array<struct<text:string,error:string>>")
    def chunks(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            if text is None:
                out.append(None)
                continue
            try:
                out.append([{"text": piece, "error": None} for piece in cut(text)])
            except Exception as failure:  # noqa: BLE001 - becomes a failure row
                out.append([{"text": None, "error": f"{type(failure).__name__}: {failure}"}])
        return pa.array(out, pa.list_(pa.struct([("text", pa.string()), ("error", pa.string())])))

    # Keeps Catalyst from copying the call into a filter and running it twice.
    return chunks.asNondeterministic()


def chunk_documents(documents: DataFrame, text="content", splitter=None) -> DataFrame:
    """One row per chunk: the other columns, `chunk_no`, `chunk`, `chunk_error`.

    Narrow: documents are split where they were read, nothing is shuffled.
    """
    rest = [name for name in documents.columns if name != text]
    pieces = documents.select(*rest, chunks_of(splitter)(F.col(text)).alias("_pieces"))
    return (pieces.select(*rest, F.posexplode("_pieces").alias("chunk_no", "_piece"))
            .select(*rest, "chunk_no", F.col("_piece.text").alias("chunk"),
                    F.col("_piece.error").alias("chunk_error")))


def chunk_id(path, chunk_no):
    """Id of a chunk: the same whenever the same file is read again."""
    return stable_uuid(path, chunk_no.cast("string"))
