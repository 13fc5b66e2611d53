"""Checks on file records, messages and batch specifications."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.names import BLANKS_PATTERN, split_ids
from docweave.schemas import FILE_METADATA, ISO_PATTERN
from docweave.session import stage

# The documented forms of timestamps and of numeric ids.
ISO_FORM = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
NUMERIC_ID = r"^[0-9]+$"
# The start of a message part that is not digits between blanks. Searched for as
# a whole, so that a long message is checked in one pass without recursion.
BAD_PART = rf"(?:\A|,)(?!{BLANKS_PATTERN}[0-9]++{BLANKS_PATTERN}(?:,|\z))"

TEXT_FIELDS = [f.name for f in FILE_METADATA.fields
               if f.dataType.typeName() == "string" and f.name != "metadata_version"]
TIME_FIELDS = ("created_at", "modified_at")


def _bad_time(df, name):
    column = F.col(name)
    if df.schema[name].dataType.typeName() != "string":
        return column.isNull()
    readable = F.try_to_timestamp(column, F.lit(ISO_PATTERN)).isNotNull()
    return ~F.coalesce(column.rlike(ISO_FORM) & readable, F.lit(False))


def _record_rules(df):
    size = F.col("size_bytes").try_cast("bigint")
    ext = F.col("extension")
    rules = [(f"{name}_empty", F.coalesce(F.col(name) == "", F.lit(True))) for name in TEXT_FIELDS]
    rules += [(f"{name}_format", _bad_time(df, name)) for name in TIME_FIELDS]
    rules += [
        ("size_bytes_negative", F.coalesce(size < 0, F.lit(True))),
        ("full_path_separator", F.coalesce(F.contains("full_path", F.lit("\\")), F.lit(False))),
        ("extension_form", F.coalesce((ext != F.lower(ext)) | ext.startswith("."), F.lit(False))),
    ]
    return rules


def rule_violations(files: DataFrame) -> DataFrame:
    """The records with `violations`: the names of the broken rules, empty if none.

    Repeated ids are counted with a partial aggregate, which is written first: the
    records are then joined with the ids that do repeat, as a rule few enough to
    broadcast, and otherwise with a join that adaptive execution splits at hot ids.
    """
    broken = [F.when(bad, F.lit(name)) for name, bad in _record_rules(files)]
    repeated = (files.groupBy("file_id").agg(F.count(F.lit(1)).alias("copies"))
                .where("copies > 1 and file_id is not null").select("file_id", F.lit(True).alias("_repeated")))
    checked = files.join(stage(repeated, "repeated-ids"), "file_id", "left")
    duplicate = F.when(F.col("_repeated"), F.lit("file_id_duplicate"))
    return (checked.withColumn("violations", F.array_compact(F.array(*broken, duplicate)))
            .select(*files.columns, "violations"))


def split_by_validity(files: DataFrame):
    """(valid records, records with at least one broken rule)."""
    checked = rule_violations(files)
    return (checked.where(F.size("violations") == 0).drop("violations"),
            checked.where(F.size("violations") > 0))


def ids_are_numeric(message):
    """True when every id of the message is made of ASCII digits."""
    return ~message.rlike(BAD_PART)


def check_messages(messages: DataFrame) -> DataFrame:
    """Messages with `valid` and the `bad_ids`; one bad id rejects the message.

    Evaluated inside each row: no shuffle.
    """
    nothing = F.array().cast("array<string>")
    bad = F.filter(split_ids("value"), lambda part: ~part.rlike(NUMERIC_ID))
    valid = F.coalesce(ids_are_numeric(F.col("value")), F.lit(False))
    return (messages.withColumn("valid", valid)
            .withColumn("bad_ids", F.when(F.col("valid"), nothing).otherwise(F.coalesce(bad, nothing))))


def message_ids(messages: DataFrame) -> DataFrame:
    """One row per message, position and trimmed id."""
    return messages.select("message_id", F.posexplode(split_ids("value")).alias("position", "id"))


def unmatched_messages(messages: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Messages none of whose ids is a key of `records`."""
    asked = messages.select("message_id", F.explode(F.array_distinct(split_ids("value"))).alias(key))
    matched = asked.join(records.select(key), key, "left_semi").select("message_id").distinct()
    return messages.join(matched, "message_id", "left_anti")


def _kind(value, path):
    """Schema text of the variant at `path`: null when missing, `VOID` for a JSON null."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def _element_rule(element):
    """The first broken rule of one element of `file_path`; null if none."""
    fields = element.try_cast("map<string,variant>")
    value = F.map_values(fields)[0]
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    metadata = _kind(value, "$.metadata")
    return (F.when(fields.isNull() | (F.size(fields) != 1), "element must have exactly one path")
            .when(~is_object, "value of the path is not an object")
            .when(metadata.isNull() | (metadata == "VOID"), "metadata missing")
            .when(~metadata.startswith("OBJECT"), "metadata is not an object"))


def batch_spec_violations(specs: DataFrame, json_column="spec") -> DataFrame:
    """Broken rules of batch specifications given as JSON text.

    One row per entry without a usable `file_path` list or `collection_name`
    (path_idx null), and one per element of `file_path` that is not
    `{path: {"metadata": {...}}}`; within an element the first broken rule counts.
    """
    doc = F.col("_doc")
    paths, name = _kind(doc, "$.file_path"), _kind(doc, "$.collection_name")
    not_object = ~F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    entry_rule = (F.when(not_object, "entry is not an object")
                  .when(paths.isNull() | (paths == "VOID"), "file_path missing")
                  .when(~paths.startswith("ARRAY"), "file_path is not a list"))
    name_rule = (F.when(not_object, None)
                 .when(name.isNull() | (name == "VOID"), "collection_name missing")
                 .when(name != "STRING", "collection_name is not a string"))

    def broken(path_idx, rule):
        return F.struct(path_idx.cast("int").alias("path_idx"), rule.alias("rule"))

    elements = F.when(entry_rule.isNull(), F.try_variant_get(doc, "$.file_path", "array<variant>"))
    found = F.concat(
        F.array(broken(F.lit(None), entry_rule), broken(F.lit(None), name_rule)),
        F.coalesce(F.transform(elements, lambda element, i: broken(i, _element_rule(element))),
                   F.array().cast("array<struct<path_idx:int,rule:string>>")))
    kept = [c for c in specs.columns if c != json_column]
    return (specs.withColumn("_doc", F.try_parse_json(json_column))
            .select(*kept, F.explode(F.filter(found, lambda b: b["rule"].isNotNull())).alias("_broken"))
            .select(*kept, "_broken.path_idx", "_broken.rule"))


def require_valid_specs(specs: DataFrame, json_column="spec", entry="entry_idx") -> None:
    """Raises ValueError for the first broken rule in entry and path order, if any."""
    first = batch_spec_violations(specs, json_column).orderBy(entry, "path_idx").first()
    if first is not None:
        raise ValueError(f"{first.rule} in entry {first[entry]}, path {first.path_idx}")
