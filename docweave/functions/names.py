"""Names, paths, id lists and time texts."""

from pyspark.sql import functions as F

# What Python's strip() removes from ASCII text.
ASCII_BLANKS = " \t\n\r\x0b\x0c"
BLANKS_PATTERN = r"[ \t\n\r\x0B\f]*"

# Time formats of the tables and of the run log.
TABLE_TIME = "yyyy-MM-dd HH:mm:ss"
LOG_TIME = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def strip(text):
    return F.btrim(text, F.lit(ASCII_BLANKS))


def extension(filename):
    """Text after the last dot, lower case; a name without a dot is returned whole."""
    return F.lower(F.substring_index(filename, ".", -1))


def base_name(path):
    return F.substring_index(path, "/", -1)


def split_ids(message):
    """Ids of a comma-separated message, each trimmed; empty parts are kept."""
    return F.split(strip(message), f"{BLANKS_PATTERN},{BLANKS_PATTERN}", -1)


def collection_of(category):
    return F.replace(category, F.lit("."), F.lit(""))


def namespace_of(category):
    return F.replace(category, F.lit("."), F.lit("_"))


def _utc_wall_clock(ts):
    return F.to_utc_timestamp(ts, F.current_timezone())


def table_time(ts):
    return F.date_format(ts, TABLE_TIME)


def log_time(ts):
    return F.date_format(_utc_wall_clock(ts), LOG_TIME)


def log_key(log_id, ts):
    """Name of a run-log entry: one per id and UTC second."""
    return F.concat(log_id, F.lit("/"), log_time(ts), F.lit(".txt"))


def decode_utf8(body):
    """Bytes as text; null where they are not valid UTF-8."""
    return F.try_validate_utf8(body.cast("string"))


def stable_uuid(*parts):
    """An id in UUID layout that is the same on every replay of the same parts."""
    digest = F.md5(F.concat_ws("|", *parts))
    pieces = [F.substring(digest, start, length)
              for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *pieces)
