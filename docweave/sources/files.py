"""File inventory, file contents and the documents inside files."""

import csv
import io
import json
import re
from itertools import chain, groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions.names import decode_utf8, extension, strip
from docweave.operators.selection import require_text
from docweave.session import stage
from docweave.sources import folders as shared

# File kinds that hold one text each, and kinds that need an
# extractor of the user; other kinds are unsupported.
TEXT_KINDS = ("txt", "md")
BINARY_KINDS = ("pdf", "xlsx", "xls", "docx", "pptx")

# Content types by extension.
CONTENT_TYPES = {
    "csv": "text/csv",
    "txt": "text/plain",
    "md": "text/markdown",
    "json": "application/json",
    "pdf": "application/pdf",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
}
UNKNOWN_TYPE = "application/octet-stream"

# One row holds one file: Spark's own limit for a binary value.
MAX_FILE_BYTES = 2**31 - 1024
# Larger CSV files of a store are read line by line, whatever their size, rather than
# inside one row.
CSV_ROW_BYTES = 16 * 1024 * 1024
# Names that do not end in .csv, as a pattern of the file reader.
NOT_CSV = "{[vV],[sS][vV],[cC][sS][vV],*[^vV],*[^sS][vV],*[^cC][sS][vV],*[^.][cC][sS][vV]}"
# Paths handed to the reader one by one; more are read by folder and joined.
MAX_LISTED_PATHS = 1_000
# Up to this many file splits (a path and two numbers each) are broadcast.
MAX_BROADCAST_SPLITS = 500_000
# A file list of at most this many rows (about 1 KB each) is broadcast.
MAX_ROWS_PER_LIST = 10_000


def content_type(ext):
    table = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(table[ext], F.lit(UNKNOWN_TYPE))


def _binary(spark, glob=None):
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", glob) if glob else reader


def inventory(spark: SparkSession, root: str, glob=None) -> DataFrame:
    """name, size, creation_time, last_modified, content_type of every file under
    `root`. File contents are not read; Spark knows no creation time, so it is null.
    As in every Spark file scan, empty files and names that start with `_` or `.`
    are not listed. A shared folder of many files is listed by the tasks."""
    require_text(root, "root")
    large = shared.large_folder(spark, root)
    if large is None:
        listed = _binary(spark, glob).load(root)
    else:
        listed = _as_spark_shows(shared.listed(spark, large, glob)).withColumn(
            "modificationTime", F.timestamp_millis("millis"))
    return listed.select(
        F.col("path").alias("name"), F.col("length").alias("size"),
        F.lit(None).cast("timestamp").alias("creation_time"),
        F.col("modificationTime").alias("last_modified"),
        content_type(extension("path")).alias("content_type"))


def _as_spark_shows(files):
    """Paths of a shared folder as Spark's file scan gives them."""
    return files.withColumn("path", F.concat(F.lit("file:"), F.col("path")))


def read_bytes(spark: SparkSession, where, glob=None, csv_apart=False) -> DataFrame:
    """path, length and content of the files under a folder, or of a list of paths.

    Files above Spark's limit for one value keep their row, with null content; with
    `csv_apart` also the CSV files that `large_csv_documents` reads. The tasks list and
    read a shared folder of many files; of these only large ones are left to Spark's scan.
    """
    folder = shared.large_folder(spark, where)
    if folder is not None:
        return _as_spark_shows(_with_contents(shared.listed(spark, folder, glob), "path", "length", "content", csv_apart)
                               .select("path", "length", "content"))
    files = _binary(spark, glob).load(where)
    length, apart = F.col("length"), F.col("length") > MAX_FILE_BYTES
    if csv_apart:
        apart = apart | _is_large_csv("path", "length")
        # The reader itself passes by the CSV files: it tells lengths and names off only.
        others = files if glob else _binary(spark, NOT_CSV).load(where)
        small = files.where((length <= MAX_FILE_BYTES) & (length <= CSV_ROW_BYTES)).unionByName(
            others.where((length <= MAX_FILE_BYTES) & (length > CSV_ROW_BYTES) & ~apart))
    else:
        small = files.where(length <= MAX_FILE_BYTES)
    large = files.where(apart).select("path", "length", F.lit(None).cast("binary").alias("content"))
    return small.select("path", "length", "content").unionByName(large)


def _with_contents(files, path, size, name, csv_apart):
    """Adds the bytes of files of a shared folder, which have plain names and sizes (null
    for what is no file); null above Spark's limit, and for `csv_apart` files."""
    wanted = F.coalesce(F.col(size) <= MAX_FILE_BYTES, F.lit(False))
    if csv_apart:
        wanted = wanted & ~F.coalesce(_is_large_csv(path, size), F.lit(False))
    by_task = F.col(size) <= shared.MAX_TASK_FILE_BYTES
    read = shared.shared_out(files, path, size).withColumn(name, shared.contents(F.when(wanted & by_task, F.col(path))))
    large = [r[0] for r in files.where(wanted & ~by_task).select(path).distinct().collect()]
    if not large:
        return read
    # One name each on the driver: these are few, as their sizes bound their number.
    found = _binary(files.sparkSession).load([shared.escaped(f"file:{p}") for p in large])
    found = found.select(_plain_path(F.col("path")).alias(path), F.col("content").alias(name))
    is_large = wanted & ~by_task
    return read.where(~is_large).unionByName(files.where(is_large).join(found, path))


def _is_large_csv(path, size):
    return (extension(path) == "csv") & (F.col(size) > CSV_ROW_BYTES)


def _plain_path(path):
    """Paths as Spark reports them and as users write them, in one form."""
    return F.regexp_replace(path, "^file:/+", "/")


def attach_bytes(files: DataFrame, root: str, csv_apart=False) -> DataFrame:
    """Adds `location`, `body_bytes` and `body` (null when the file is missing, empty
    or too large for one row; see `read_bytes` for `csv_apart`).

    `full_path` is taken relative to `root`. A short list of files is read path by
    path, with the list broadcast to the scan so that file contents are never
    shuffled; a longer one is joined with a scan of its folders, or of the root
    when those are many too. In a shared folder the tasks open the files of a longer list
    themselves: the driver lists nothing, and no contents are shuffled.
    """
    spark = files.sparkSession
    location = F.concat(F.lit(require_text(root, "root").rstrip("/") + "/"),
                        F.ltrim(F.col("full_path"), F.lit("/")))
    located = files.withColumn("location", _plain_path(location))
    wanted = [r[0] for r in located.select("location").where("location is not null").distinct()
              .limit(MAX_LISTED_PATHS + 1).collect()]
    short = len(wanted) <= MAX_LISTED_PATHS
    if not short:
        folder = F.regexp_replace("location", "/[^/]*$", "")
        folders = [r[0] for r in located.where("location is not null").select(folder).distinct()
                   .limit(MAX_LISTED_PATHS + 1).collect()]
        wanted = _outermost(folders) if len(folders) <= MAX_LISTED_PATHS else [root]
    source = _existing(spark, root, wanted)
    if not source:
        return located.select("*", F.lit(None).cast("bigint").alias("body_bytes"),
                              F.lit(None).cast("binary").alias("body"))
    if not short and shared.is_shared(spark, root):
        return _opened_by_tasks(located, [re.sub("^file:/+", "/", p).rstrip("/") for p in wanted], csv_apart)
    found = read_bytes(spark, source, csv_apart=csv_apart).select(
        _plain_path(F.col("path")).alias("location"), F.col("length").alias("body_bytes"),
        F.col("content").alias("body"))
    if short and located.limit(MAX_ROWS_PER_LIST + 1).count() <= MAX_ROWS_PER_LIST:
        present = found.join(F.broadcast(located), "location")
    else:
        present = found.join(located, "location")
    absent = located.join(found.select("location"), "location", "left_anti")
    return present.unionByName(absent, allowMissingColumns=True)


def _opened_by_tasks(located, roots, csv_apart):
    """`attach_bytes` for files in a shared folder; a file counts if a scan of one of the
    folders `roots` would list it."""
    kept = [c for c in located.columns if c != "location"]
    tasks = shared.shares(located.sparkSession, located.count())
    sized = stage(located.repartition(tasks, "location").withColumn("body_bytes", shared.sizes(F.col("location"), roots)),
                  "located-files")
    return _with_contents(sized, "location", "body_bytes", "body", csv_apart).select("location", "body_bytes", "body", *kept)


def _outermost(folders):
    """The folders that lie in no other of them, as folders are read with all below."""
    kept = []
    for folder in sorted(folders, key=lambda f: f + "/"):
        if not kept or not (folder + "/").startswith(kept[-1] + "/"):
            kept.append(folder)
    return kept


def _existing(spark, root, paths):
    """The paths that exist, escaped for the reader: a missing one would fail the read."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    return [shared.escaped(p) for p in paths if fs.exists(jvm.org.apache.hadoop.fs.Path(p))]


# Documents -------------------------------------------------------------------

def row_documents(rows: DataFrame, columns=None) -> DataFrame:
    """Adds `content`: one `column: value` line per column, both trimmed."""
    columns = columns or rows.columns
    lines = [F.concat(F.lit(f"{name.strip()}: "), strip(F.coalesce(F.col(name).cast("string"), F.lit(""))))
             for name in columns]
    return rows.withColumn("content", F.concat_ws("\n", *lines))


def csv_documents(spark: SparkSession, paths, multiline=True) -> DataFrame:
    """One document per CSV row: content, and metadata with `source` and `row`.

    For files that share one header. `multiline=False` lets Spark split large
    files, when no quoted value contains a line break. Rows are numbered from
    their position in the split and the sizes of the splits before it. Rows with
    more or fewer values than the header are parsed again in Python, as the reader
    would drop or null the difference.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    names = reader.csv(paths).columns
    fields = [T.StructField(name, T.StringType()) for name in [*names, "_malformed"]]
    # A file with another header fails the read, rather than being read by position.
    rows = (reader.schema(T.StructType(fields)).option("multiLine", multiline).option("enforceSchema", False)
            .option("columnNameOfCorruptRecord", "_malformed").csv(paths))
    header = io.StringIO()
    csv.writer(header).writerow(names)
    ragged = F.when(F.col("_malformed").isNotNull(), F.concat(F.lit(header.getvalue()), F.col("_malformed")))
    parsed = _parsed_bodies({})(F.lit("csv"), ragged.cast("binary"))
    documents = row_documents(rows, names).select(
        F.coalesce(F.get(parsed, 0)["text"], F.col("content")).alias("content"), _source().alias("source"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"))
    # Written once: a second scan could be cut into other splits.
    documents = stage(documents, "csv-rows")
    splits = documents.groupBy("source", "_block").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = (Window.partitionBy("source").orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("source", "_block", (F.coalesce(F.sum("_rows").over(before), F.lit(0))
                                                - F.col("_first")).alias("_shift"))
    splits = stage(splits, "csv-splits")
    if splits.count() <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    row = (F.col("_id") + F.col("_shift")).cast("string")
    return documents.join(splits, ["source", "_block"]).select(
        "content", F.create_map(F.lit("source"), F.col("source"), F.lit("row"), row).alias("metadata"))


def _source():
    """Path of the file a row comes from, as the user wrote it (Spark encodes it)."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def text_documents(spark: SparkSession, paths, glob=None) -> DataFrame:
    """One document per text file: content, metadata with `source`, and error."""
    reader = spark.read.option("wholetext", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    text = F.try_validate_utf8(F.col("value"))
    return reader.text(paths).select(
        text.alias("content"), F.create_map(F.lit("source"), _source()).alias("metadata"),
        F.when(text.isNull(), "not valid UTF-8").alias("error"))


def json_documents(spark: SparkSession, paths, glob=None) -> DataFrame:
    """One document per JSON file; `content` is null and `error` set where it is not JSON."""
    texts = text_documents(spark, paths, glob)
    content = compact_json(F.col("content"))
    return texts.select(content.alias("content"), "metadata",
                        F.coalesce("error", F.when(content.isNull(), "not valid JSON")).alias("error"))


# Fixed value: a JSON string literal, or blanks outside of one.
JSON_STRING_OR_BLANKS = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|[ \t\r\n]++'


_JSON_BLANKS = re.compile(JSON_STRING_OR_BLANKS)


def _compact(text):
    """JSON text without blanks between its parts, or None. Numbers may be of any length,
    NaN and infinities are let through; a string that is no text (half a pair of
    surrogates) is not JSON."""
    try:
        value = json.loads(text, parse_int=str, parse_float=str)
        if isinstance(value, str) and text.lstrip()[:1] == '"':
            value.encode("utf-8")
            return value
    except (ValueError, RecursionError):
        return None
    return _JSON_BLANKS.sub(lambda m: m[1] or "", text)


def compact_json(text):
    """JSON text without blanks between its parts; keys keep their order, also if they
    repeat, and numbers their digits. A top-level string is returned as that string;
    what is not JSON gives null. One parser for texts of every size."""
    @F.arrow_udf("string")
    def compacted(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _compact(t) for t in texts.to_pylist()], pa.string())

    return compacted.asNondeterministic()(text)


def _csv_rows(lines):
    """Lines of a CSV file -> one text per row, as `column: value` lines."""
    def shown(value):
        if isinstance(value, list):
            return ",".join(v.strip() for v in value)
        return value.strip() if isinstance(value, str) else value

    csv.field_size_limit(MAX_FILE_BYTES)
    for row in csv.DictReader(lines):
        yield "\n".join(f"{shown(k)}: {shown(v)}" for k, v in row.items())


def _csv_texts(body):
    return list(_csv_rows(io.StringIO(body.decode("utf-8"), newline="")))


def _failure(failure):
    return f"{type(failure).__name__}: {failure}".encode("utf-8", "backslashreplace").decode("utf-8")


def _checked(text):
    """A text that Spark can hold: an extractor may return anything."""
    if text is None:
        return None
    if not isinstance(text, str):
        raise TypeError(f"an extractor gave {type(text).__name__}, not text")
    text.encode("utf-8")
    return text


def _decoded(lines, marked):
    """Bytes between line feeds -> lines as a text file gives them."""
    for n, line in enumerate(lines):
        text = line.decode("utf-8") + "\n"
        yield from io.StringIO("\ufeff" + text if marked and n == 0 else text, newline="")


# What the parser of small files takes for a field. A quote opens one only
# at its start; what follows the closing quote belongs to the field as it is.
_FIELD = rb'(?:"[^"]*+(?:""[^"]*+)*+"[^,\r]*+|(?!")[^,\r]*+)'
_FROM_OUTSIDE = re.compile(_FIELD + rb"(?:[,\r]" + _FIELD + rb")*+\Z")
_FROM_INSIDE = re.compile(rb'[^"]*+(?:""[^"]*+)*+"[^,\r]*+(?:[,\r]' + _FIELD + rb")*+\Z")


def _inside_after(line, inside):
    """Whether a quoted field is open after a line that begins inside one, or outside."""
    if b'"' not in line:
        return inside
    return (_FROM_INSIDE if inside else _FROM_OUTSIDE).match(line) is None


def _by_split(batches, columns):
    """(path, block), rows of the task's splits in order."""
    rows = (row for batch in batches for row in zip(*[batch.column(i).to_pylist() for i in range(columns)]))
    return groupby(rows, key=itemgetter(0, 1))


def _scan_quotes(marked):
    """path, block, line -> for each split: whether a quoted field is open at its end if
    none is, or one is, at its start; whether a record starts in it in the second case;
    the lines of the file's first record."""
    def run(batches):
        for (path, block), rows in _by_split(batches, 3):
            out, inside, starts, header, open_ = False, True, False, [], block == 0
            for n, (_, _, line) in enumerate(rows):
                if open_:
                    header.append(line)
                starts = starts or n > 0 and not inside
                # A byte order mark makes the first field one that is not quoted.
                shown = b"\xef\xbb\xbf" + line if block == 0 and n == 0 and path in marked else line
                alike = out == inside
                out = _inside_after(shown, out)
                inside = out if alike else _inside_after(line, inside)
                open_ = open_ and out
            yield pa.RecordBatch.from_pylist(
                [{"path": path, "block": block, "out": out, "inside": inside, "starts": starts, "header": header}],
                pa.schema([("path", pa.string()), ("block", pa.int64()), ("out", pa.bool_()), ("inside", pa.bool_()),
                           ("starts", pa.bool_()), ("header", pa.list_(pa.binary()))]))
    return run


def _settled_splits(scanned):
    """path, block, whether it begins inside a quoted field, and the split that the record
    it begins in started in.

    Of the two states at a split's end one may not depend on its start (a reset);
    otherwise it is kept or swapped. So the state is that of the last reset, swapped as
    often as splits since then say."""
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    reset = F.col("out") == F.col("inside")
    marks = scanned.withColumns({
        "value": F.last(F.when(reset, F.col("out")), ignorenulls=True).over(before),
        "swaps": F.coalesce(F.sum(F.when(~reset & F.col("out"), 1).otherwise(0)).over(before), F.lit(0)),
        "own": F.sum(F.when(~reset & F.col("out"), 1).otherwise(0)).over(
            Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))})
    at_reset = F.coalesce(F.last(F.when(reset, F.col("own")), ignorenulls=True).over(before), F.lit(0))
    odd = (F.col("swaps") - at_reset) % 2 == 1
    began = marks.withColumn("began", F.coalesce("value", F.lit(False)) != odd)
    owner = F.last(F.when(~F.col("began") | F.col("starts"), F.col("block")), ignorenulls=True).over(before)
    return began.select("path", "block", "began", owner.alias("earlier"))


def _owned_lines(batches):
    """path, block, id, line, began, earlier -> path, owner, block, id, line: lines that
    finish the record of an earlier split go to that one."""
    for (path, block), rows in _by_split(batches, 6):
        started, inside = False, None
        while part := list(islice(rows, 10_000)):
            made = []
            for _, _, place, line, began, earlier in part:
                inside = began if inside is None else inside
                started = started or not inside
                made.append((path, block if started else earlier, block, place, line))
                if not started:
                    inside = _inside_after(line, inside)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*made), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["path", "owner", "block", "id", "line"])


def _parsed_lines(marked, headers, rows=1_000, chars=4_000_000):
    """path, owner, line in the order of the files -> path, owner, n, content, error; only
    the rows that are written next are held. A part that fails gives its error last."""
    def run(batches):
        made, size = [], 0
        types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())

        def written():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*made), types)], names=["path", "owner", "n", "content", "error"])
            made.clear()
            return batch

        for (path, owner), own in _by_split(batches, 3):
            n, lines = 0, map(itemgetter(2), own)
            if owner:
                lines = chain(headers.value[path], lines)
            try:
                for text in _csv_rows(_decoded(lines, path in marked)):
                    made.append((path, owner, n, text, None))
                    n, size = n + 1, size + len(text)
                    if len(made) >= rows or size >= chars:
                        yield written()
                        size = 0
            except (csv.Error, UnicodeError) as failure:
                made.append((path, owner, n, None, _failure(failure)))
        if made:
            yield written()
    return run


def _marked(spark, paths):
    """The paths of files with a byte order mark, which Spark's line reader drops."""
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    out = set()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        stream = place.getFileSystem(conf).open(place)
        try:
            if all(stream.read() == byte for byte in b"\xef\xbb\xbf"):
                out.add(path)
        finally:
            stream.close()
    return out


def large_csv_documents(files: DataFrame) -> DataFrame | None:
    """Documents of the CSV files among `files` (see `attach_bytes`) above
    `CSV_ROW_BYTES`: the file's columns, doc_no, content, error. None if there are none.

    Spark reads the lines, so any store it opens will do, and cuts files into splits,
    which are parsed by as many tasks. A first pass says for each split how quoted fields
    that are open at its start or not leave its end; from these the state at every start
    follows. Lines that finish a record of an earlier split are moved there, and each part
    passes, after the header, through the parser of the small files. Rows are numbered by
    the counts of the parts before. What lies between two line feeds must fit one value
    (2 GB). Only paths and headers come to the driver.
    """
    spark = files.sparkSession
    kept = [c for c in files.columns if c not in ("body", "body_bytes", "location")]
    large = stage(files.where(_is_large_csv("location", "body_bytes")).select(*kept, F.col("location").alias("_path")),
                  "large-csv")
    paths = [r[0] for r in large.select("_path").distinct().collect()]
    if not paths:
        return None
    marked = _marked(spark, paths)
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text([shared.escaped(p) for p in paths])
    lines = lines.select(
        _plain_path(_source()).alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").cast("binary").alias("line"))
    scanned = stage(lines.select("path", "block", "line").mapInArrow(
        _scan_quotes(marked), "path string, block long, out boolean, inside boolean, starts boolean, header array<binary>"),
        "large-csv-splits")
    first = scanned.where("block = 0").select("path", "header").collect()  # one row a path
    headers = spark.sparkContext.broadcast({r["path"]: [bytes(line) for line in r["header"]] for r in first})
    splits = stage(_settled_splits(scanned), "large-csv-states")
    if splits.count() <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    owned = lines.join(splits, ["path", "block"]).select("path", "block", "id", "line", "began", "earlier").mapInArrow(
        _owned_lines, "path string, owner long, block long, id long, line binary")
    ordered = owned.repartition("path", "owner").sortWithinPartitions("path", "owner", "block", "id")
    parsed = stage(ordered.select("path", "owner", "line").mapInArrow(
        _parsed_lines(marked, headers), "path string, owner long, n long, content string, error string"), "large-csv-rows")
    # As with small files, one that fails midway gives its first error and nothing else.
    failed = parsed.where("error is not null").groupBy("path").agg(F.min_by("error", "owner").alias("error"))
    counts = parsed.groupBy("path", "owner").agg(F.count("content").alias("rows"))
    before = Window.partitionBy("path").orderBy("owner").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stage(counts.select("path", "owner", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift")),
                   "large-csv-shifts")
    if shifts.count() <= MAX_BROADCAST_SPLITS:
        shifts = F.broadcast(shifts)
    whole = parsed.join(failed.select("path"), "path", "left_anti").join(shifts, ["path", "owner"]).select(
        "path", (F.col("n") + F.col("shift")).alias("doc_no"), "content", "error")
    whole = whole.unionByName(failed.select("path", F.lit(0).cast("long").alias("doc_no"),
                                            F.lit(None).cast("string").alias("content"), "error"))
    # A file of a header alone has no rows.
    error = F.when(F.col("path").isNull(), "no documents").otherwise(F.col("error"))
    return large.join(whole, large["_path"] == whole["path"], "left").select(
        *kept, F.coalesce("doc_no", F.lit(0).cast("long")).alias("doc_no"), "content", error.alias("error"))


def _parsed_bodies(extractors):
    """Column function (kind, bytes) -> array<struct<text, error>> for the kinds that
    need Python. Rows with null bytes cost nothing; a failing file gives its error."""
    readers = {**extractors, "csv": _csv_texts}

    @F.arrow_udf("array<struct<text:string,error:string>>")
    def parse(kinds: pa.Array, bodies: pa.Array) -> pa.Array:
        out = []
        for kind, body in zip(kinds, bodies):
            body = body.as_py()
            if body is None:
                out.append(None)
                continue
            try:
                out.append([{"text": _checked(text), "error": None} for text in readers[kind.as_py()](body)])
            except Exception as failure:  # noqa: BLE001 - becomes a failure row
                out.append([{"text": None, "error": _failure(failure)}])
        return pa.array(out, pa.list_(pa.struct([("text", pa.string()), ("error", pa.string())])))

    # Keeps Catalyst from copying the call into a filter and running it twice.
    return parse.asNondeterministic()


def file_documents(files: DataFrame, extractors=None) -> DataFrame:
    """One row per document of each file: the file's columns (without the bytes),
    `doc_no`, `content`, `error`.

    `files` has `full_path` and `body`. The kind is the extension in lower case.
    Every file gives at least one row; what cannot be read is a row with an
    error. All kinds are handled in one pass, so each file is read once, and only
    CSV, JSON and extractor kinds cross to Python.
    """
    extractors = {k.lower(): v for k, v in (extractors or {}).items()}
    kept = [c for c in files.columns if c != "body"]
    kind, body, text = F.col("_kind"), F.col("body"), F.col("_text")
    unread = [k for k in BINARY_KINDS if k not in extractors]
    known = [*TEXT_KINDS, "json", "csv", *BINARY_KINDS, *extractors]
    in_python = kind.isin(["csv", *extractors])

    # One step per column, so that no text is decoded or parsed twice.
    rows = files.withColumn("_kind", F.coalesce(extension("full_path"), F.lit("")))
    rows = rows.select(
        *kept, "_kind", body.isNull().alias("_absent"), in_python.alias("_in_python"),
        F.when(~in_python & kind.isin([*TEXT_KINDS, "json"]), decode_utf8(body)).alias("_text"),
        _parsed_bodies(extractors)(kind, F.when(in_python, body)).alias("_parsed"))
    rows = rows.withColumn("_content", F.when(kind == "json", compact_json(F.when(kind == "json", text))).otherwise(text))
    error = (F.when(~kind.isin(known), F.concat(F.lit("unsupported format: "), kind))
             .when(kind.isin(unread), F.concat(F.lit("no extractor for "), kind))
             .when(F.col("_absent"), "file not found, empty or too large")
             .when(F.col("_in_python"), F.when(F.size("_parsed") == 0, "no documents"))
             .when(text.isNull(), "not valid UTF-8")
             .when(F.col("_content").isNull(), "not valid JSON"))
    single = F.array(F.struct(F.col("_content").alias("text"), error.alias("error")))
    documents = F.when(F.size("_parsed") > 0, F.col("_parsed")).otherwise(single)
    return (rows.select(*kept, F.posexplode(documents).alias("doc_no", "_doc"))
            .select(*kept, "doc_no", F.col("_doc.text").alias("content"), F.col("_doc.error").alias("error")))


def load_documents(spark: SparkSession, where, extractors=None, glob=None) -> DataFrame:
    """Documents of all files under a folder, or of a list of paths, by extension:
    content, metadata with `source` and `row`, and error."""
    files = read_bytes(spark, where, glob, csv_apart=True).select(
        F.col("path").alias("full_path"), _plain_path(F.col("path")).alias("location"),
        F.col("length").alias("body_bytes"), F.col("content").alias("body"))
    return stored_documents(files, extractors).select(
        "content", F.create_map(F.lit("source"), F.col("full_path"), F.lit("row"), F.col("doc_no").cast("string"))
        .alias("metadata"), "error")


def stored_documents(located: DataFrame, extractors=None) -> DataFrame:
    """`file_documents` of files with `location`, `body_bytes` and `body`, read with
    `csv_apart`: large CSV files are streamed."""
    kept = [c for c in located.columns if c not in ("location", "body_bytes")]
    large = large_csv_documents(located)
    if large is None:
        return file_documents(located.select(*kept), extractors)
    usual = located.where(~F.coalesce(_is_large_csv("location", "body_bytes"), F.lit(False)))
    return file_documents(usual.select(*kept), extractors).unionByName(large)
