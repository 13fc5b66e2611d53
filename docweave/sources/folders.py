"""Folders of many files, listed and read by the tasks.

Spark's file scan keeps the status, the split and, of a partitioned folder, the partition
of every file on the driver. In a shared folder (`file:`) the tasks can list and open the
files themselves, so the driver holds none of them. The rows are those of Spark's scan:
empty files and names that start with `_` or `.` are passed by.
"""

import math
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.session import stage

# A folder of at most this many entries is left to Spark's file scan.
MAX_SCANNED_ENTRIES = 10_000
# Larger files are left to Spark's file scan, as the share of the driver is small there.
MAX_TASK_FILE_BYTES = 16 * 1024 * 1024
# Folders that a task lists for each one it is given, before it hands on the rest.
FOLDERS_PER_WALK = 1_000
# Files (or folders) and bytes that make one task.
FILES_PER_TASK, BYTES_PER_TASK = 4_000, 128 * 1024 * 1024
# Rows and bytes of a batch that a task gives.
BATCH_ROWS, BATCH_BYTES = 5_000, 4 * 1024 * 1024

_GLOB_MARKS = re.compile(r"[\\\[\]{}*?]")


def escaped(path):
    """A path the reader takes literally, not as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def shares(spark, files, size=0) -> int:
    """Tasks for work on so many files of so many bytes."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(files / FILES_PER_TASK), math.ceil(size / BYTES_PER_TASK))


def is_shared(spark: SparkSession, path: str) -> bool:
    """Whether the tasks can open what is under the path by its plain name."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"


def large_folder(spark: SparkSession, where) -> str | None:
    """The plain name of the folder `where`, if it is one of many files that the tasks can
    list; None for all that is left to Spark's file scan."""
    if not isinstance(where, str):
        where = where[0] if len(where) == 1 else ""
    if not where or _GLOB_MARKS.search(where) or not is_shared(spark, where):
        return None
    place = spark._jvm.org.apache.hadoop.fs.Path(where)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = system.makeQualified(place).toUri().getPath()
    return folder if os.path.isdir(folder) and _holds_more(folder, MAX_SCANNED_ENTRIES) else None


def _holds_more(folder, most):
    """Whether there are more entries; no more than those are looked at."""
    seen, left = 0, [folder]
    while left:
        try:
            with os.scandir(left.pop()) as entries:
                for entry in entries:
                    seen += 1
                    if seen > most:
                        return True
                    if entry.is_dir():
                        left.append(entry.path)
        except OSError:
            return False  # Spark's scan says what is wrong.
    return False


def _passed_by(name, folder):
    """Names that Spark's file scan does not list."""
    hidden = name.startswith("_") and "=" not in name or name.startswith(".")
    if folder:
        return (hidden or name.endswith("._COPYING_")) and not name.startswith(("_common_metadata", "_metadata"))
    return hidden or name.endswith("._COPYING_")


def _is_text(name):
    try:
        name.encode()
    except UnicodeEncodeError:
        return False
    return True


_LISTED = pa.schema([("path", pa.string()), ("folder", pa.bool_()), ("length", pa.int64()), ("millis", pa.int64())])


def _walk(pattern, most):
    """path of a folder -> what lies in it; the folders among these are walked too, unless
    they are more than `most`: then they are given, to be walked by other tasks."""
    chosen = re.compile(pattern, re.DOTALL).fullmatch if pattern else lambda _: True

    def entries_of(folder):
        walked, left = 0, [folder]
        while left:
            with os.scandir(left.pop()) as entries:
                walked += 1
                for entry in entries:
                    try:
                        below = entry.is_dir()
                        if _passed_by(entry.name, below) or not _is_text(entry.name):
                            continue
                        if below and walked + len(left) < most:
                            left.append(entry.path)
                        elif below:
                            yield entry.path, True, None, None
                        elif chosen(entry.name) and (status := entry.stat()).st_size:
                            yield entry.path, False, status.st_size, status.st_mtime_ns // 1_000_000
                    except FileNotFoundError:  # It went away meanwhile, or is a link to nothing.
                        continue

    def run(batches):
        made = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for row in entries_of(folder):
                    made.append(row)
                    if len(made) >= BATCH_ROWS:
                        yield _batch(made, _LISTED)
                        made = []
        if made:
            yield _batch(made, _LISTED)

    return run


def _batch(made, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)


def listed(spark: SparkSession, folder: str, glob=None) -> DataFrame:
    """path (a plain name), length and millis (of the last change) of the files below.

    Round by round: folders that a task does not walk are shared out in the next one."""
    pattern = None
    if glob:
        pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    left, files = spark.createDataFrame([(folder,)], "path string"), None
    while True:
        found = stage(left.mapInArrow(_walk(pattern, FOLDERS_PER_WALK), "path string, folder boolean, length long, millis long"),
                      "listed")
        own = found.where("not folder").select("path", "length", "millis")
        files = own if files is None else files.unionByName(own)
        folders = found.where("folder").select("path")
        count = folders.count()
        if not count:
            return files
        left = folders.repartition(shares(spark, count), "path")


def shared_out(files: DataFrame, path="path", length="length") -> DataFrame:
    """Files in even shares for tasks that read them."""
    count, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum(length), F.lit(0))).first()
    return files.repartition(shares(files.sparkSession, count, size), path)


def _read_file(path):
    with open(path, "rb") as file:
        return file.read()


def contents(path):
    """Column function: plain name of a file -> its bytes; null without a name. For files
    of at most `MAX_TASK_FILE_BYTES`; a column that is not used is not read."""
    @F.arrow_udf("binary")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            made, size = [], 0
            for name in batch.to_pylist():
                made.append(None if name is None else _read_file(name))
                size += len(made[-1] or b"")
                if size >= BATCH_BYTES:
                    yield pa.array(made, pa.binary())
                    made, size = [], 0
            if made:
                yield pa.array(made, pa.binary())

    return read.asNondeterministic()(path)


def sizes(path, roots):
    """Column function: plain name -> bytes of the file, if a scan of one of the folders
    `roots` would list it; otherwise null."""
    roots = frozenset(roots)

    @F.arrow_udf("bigint")
    def size(paths: pa.Array) -> pa.Array:
        return pa.array([_size(name, roots) for name in paths.to_pylist()], pa.int64())

    return size.asNondeterministic()(path)


def _size(path, roots):
    if path is None or not path.startswith("/") or os.path.normpath(path) != path:
        return None
    above, _, name = path.rpartition("/")
    if _passed_by(name, False):
        return None
    while above not in roots:
        above, _, name = above.rpartition("/")
        if not name or _passed_by(name, True):
            return None
    try:
        return (os.stat(path).st_size or None) if os.path.isfile(path) else None
    except (OSError, ValueError):
        return None


_LINES = pa.schema([("path", pa.string()), ("value", pa.binary())])


def _lines(batches):
    """path -> a row for each line of the file, as Spark's line reader gives them."""
    made, size = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open(path, "rb") as file:
                for n, line in enumerate(file):
                    # Which drops a byte order mark.
                    line = (line.removeprefix(b"\xef\xbb\xbf") if n == 0 else line).removesuffix(b"\n")
                    made.append((path, line))
                    size += len(line)
                    if len(made) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield _batch(made, _LINES)
                        made, size = [], 0
    if made:
        yield _batch(made, _LINES)


def lines(files: DataFrame) -> DataFrame:
    """path, value: the lines of files that `listed` found."""
    spark = files.sparkSession
    small = shared_out(files.where(F.col("length") <= MAX_TASK_FILE_BYTES))
    read = small.select("path").mapInArrow(_lines, "path string, value binary").select("path", F.col("value").cast("string"))
    large = [r[0] for r in files.where(F.col("length") > MAX_TASK_FILE_BYTES).select("path").collect()]
    if not large:
        return read
    # Cut into splits, which as many tasks read.
    cut = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text([escaped(f"file:{p}") for p in large])
    path = F.regexp_replace(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    return read.unionByName(cut.select(path.alias("path"), "value"))
