"""Table schemas and the strict projection onto them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, TS = T.StringType(), T.LongType(), T.TimestampType()


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


FILE_METADATA = _struct(
    ("file_id", S), ("parent_id", S), ("filename", S), ("full_path", S), ("category", S),
    ("size_bytes", L), ("created_at", TS), ("modified_at", TS), ("created_by", S),
    ("content_type", S), ("extension", S), ("mime_type", S), ("metadata_version", S),
)
FILE_DEFAULTS = {"metadata_version": "1.0"}

METHOD_METADATA = _struct(
    ("method_id", S), ("uuid", S), ("method_name", S), ("segment", S), ("category", S),
    ("description", S), ("created_by", S), ("updated_by", S),
    ("vector_created_at", TS), ("vector_updated_at", TS),
)

METHOD_RECORD = _struct(
    ("metadata", _struct(
        ("method_name", S), ("segment", S), ("category", S),
        ("created_by", S), ("updated_by", S), ("method_id", S),
    )),
    ("content", S),
)

VECTORS = _struct(
    ("id", S), ("embedding", T.ArrayType(T.FloatType())), ("content", S),
    ("metadata", T.MapType(S, S)), ("namespace", S),
)

COLLECTIONS = _struct(("name", S), ("created_at", TS), ("type", S))

# A vector written without a namespace is stored under this name: a null would
# fall out of anti joins, and an empty partition value is read back as null.
DEFAULT_NAMESPACE = "default"

# Fixed value: the documented timestamp form, YYYY-MM-DDTHH:MM:SSZ.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"


def _read_as(df, field):
    source = F.col(field.name)
    if df.schema[field.name].dataType == field.dataType:
        return source
    if isinstance(field.dataType, T.TimestampType) and df.schema[field.name].dataType == S:
        return F.try_to_timestamp(source, F.lit(ISO_PATTERN))
    return source.try_cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType, defaults=None) -> DataFrame:
    """Exactly the columns of `schema`, typed; a missing or extra column is an error.

    The names are compared when the plan is built. Values that cannot be read as
    the declared type become null; `quality.rule_violations` on the raw rows
    names them.
    """
    defaults = defaults or {}
    wanted, present = set(schema.names), set(df.columns)
    missing = sorted(wanted - present - set(defaults))
    extra = sorted(present - wanted)
    if missing or extra:
        raise ValueError(f"columns do not fit the schema: missing {missing}, unexpected {extra}")
    columns = []
    for field in schema.fields:
        if field.name in present:
            value = _read_as(df, field)
            if field.name in defaults:
                value = F.coalesce(value, F.lit(defaults[field.name]))
        else:
            value = F.lit(defaults[field.name]).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def conform_files(df: DataFrame) -> DataFrame:
    return conform(df, FILE_METADATA, FILE_DEFAULTS)
