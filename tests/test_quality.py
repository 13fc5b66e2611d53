import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from docweave.functions.maps import fill_nulls, merge
from docweave.functions.names import decode_utf8, extension, log_key, split_ids, stable_uuid, table_time
from docweave.operators import quality as q
from docweave.operators.selection import by_ids, in_namespace, with_metadata
from docweave.schemas import FILE_METADATA, conform_files

GOOD = {
    "file_id": "f1", "parent_id": "p", "filename": "a.pdf", "full_path": "/x/a.pdf", "category": "c",
    "size_bytes": "10", "created_at": "2024-03-21T10:00:00Z", "modified_at": "2024-03-21T10:00:00Z",
    "created_by": "u", "content_type": "document", "extension": "pdf", "mime_type": "application/pdf",
    "metadata_version": None}


def files(spark, *changes):
    schema = ", ".join(f"{n} string" for n in FILE_METADATA.names)
    return spark.createDataFrame([tuple({**GOOD, **c}.values()) for c in changes], schema)


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column).first()[0]


def test_conform_types_defaults_and_strictness(spark):
    row = conform_files(files(spark, {}, {"size_bytes": "many", "created_at": "soon"})).collect()
    assert row[0].metadata_version == "1.0" and row[0].size_bytes == 10
    assert str(row[0].created_at) == "2024-03-21 10:00:00" or row[0].created_at is not None
    assert row[1].size_bytes is None and row[1].created_at is None
    with pytest.raises(ValueError, match="extra_one"):
        conform_files(files(spark, {}).withColumn("extra_one", F.lit(1)))
    with pytest.raises(ValueError, match="category"):
        conform_files(files(spark, {}).drop("category"))
    assert conform_files(files(spark, {}).drop("metadata_version")).first().metadata_version == "1.0"


@pytest.mark.parametrize("change, rule", [
    ({"category": ""}, "category_empty"), ({"created_by": None}, "created_by_empty"),
    ({"created_at": "2024-03-21 10:00:00"}, "created_at_format"), ({"modified_at": "2024-02-31T10:00:00Z"}, "modified_at_format"),
    ({"size_bytes": "-1"}, "size_bytes_negative"), ({"size_bytes": "x"}, "size_bytes_negative"),
    ({"full_path": "x\\a.pdf"}, "full_path_separator"), ({"extension": "PDF"}, "extension_form"),
    ({"extension": ".pdf"}, "extension_form")])
def test_each_rule(spark, change, rule):
    assert q.rule_violations(files(spark, change)).first().violations == [rule]


def test_valid_invalid_split_and_duplicates(spark):
    valid, invalid = q.split_by_validity(files(spark, {}, {"file_id": "f2"}, {"file_id": "f2"}))
    assert [r.file_id for r in valid.collect()] == ["f1"]
    assert [r.violations for r in invalid.collect()] == [["file_id_duplicate"]] * 2


@pytest.mark.parametrize("message, ids, valid", [
    ("1,2", ["1", "2"], True), (" 1 ,\t2\n", ["1", "2"], True), ("1,,2", ["1", "", "2"], False),
    ("1,", ["1", ""], False), ("", [""], False), ("1,x", ["1", "x"], False), ("1 2", ["1 2"], False),
    ("٣", ["٣"], False), ("-1", ["-1"], False), ("1\n,2\n", ["1", "2"], True), ("a,1", ["a", "1"], False),
    (",".join(["123"] * 50_000), ["123"] * 50_000, True)])
def test_messages(spark, message, ids, valid):
    frame = spark.createDataFrame([("m", message)], "message_id string, value string")
    row = q.check_messages(frame).select("*", split_ids("value").alias("ids")).first()
    assert row.ids == ids and row.valid is valid
    assert row.bad_ids == ([] if valid else [i for i in ids if not (i.isascii() and i.isdigit())])


def test_null_message_is_invalid(spark):
    frame = spark.createDataFrame([("m", None)], "message_id string, value string")
    assert q.check_messages(frame).first().valid is False


def test_unmatched_messages(spark):
    messages = spark.createDataFrame([("a", "1, 7"), ("b", "8"), ("c", "8,9")], "message_id string, value string")
    known = spark.createDataFrame([("1",), ("9",)], "k string")
    assert rows(q.unmatched_messages(messages, known, "k").select("message_id")) == [("b",)]


@pytest.mark.parametrize("spec, found", [
    ('{"file_path": [{"/a": {"metadata": {"k": "v"}}}], "collection_name": "c"}', []),
    ('{"file_path": [], "collection_name": "c"}', []),
    ('[]', [(None, "entry is not an object")]), ('not json', [(None, "entry is not an object")]),
    ('{"collection_name": "c"}', [(None, "file_path missing")]),
    ('{"file_path": null, "collection_name": "c"}', [(None, "file_path missing")]),
    ('{"file_path": {"a": 1}, "collection_name": "c"}', [(None, "file_path is not a list")]),
    ('{"file_path": [{}, {"/a": {"metadata": {}}, "/b": {"metadata": {}}}, 5], "collection_name": "c"}',
     [(0, "element must have exactly one path"), (1, "element must have exactly one path"),
      (2, "element must have exactly one path")]),
    ('{"file_path": [{"/a": 1}, {"/a": {}}, {"/a": {"metadata": null}}, {"/a": {"metadata": []}}], "collection_name": "c"}',
     [(0, "value of the path is not an object"), (1, "metadata missing"), (2, "metadata missing"),
      (3, "metadata is not an object")]),
    ('{"file_path": "x", "collection_name": 5}',
     [(None, "collection_name is not a string"), (None, "file_path is not a list")])])
def test_batch_specs(spark, spec, found):
    frame = spark.createDataFrame([(0, spec)], "entry_idx int, spec string")
    assert rows(q.batch_spec_violations(frame).select("path_idx", "rule")) == sorted(found, key=str)


def test_ids_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    files(spark, {}, {"file_id": "f2"}).write.parquet(path)
    stored = spark.read.parquet(path)
    few = by_ids(stored, ["f1", "f1"], "file_id")
    assert few.count() == 1 and "PushedFilters: [IsNotNull" in plan(few) or "In(file_id" in plan(few) or "EqualTo" in plan(few)
    many = by_ids(stored, [f"f{i}" for i in range(2000)], "file_id")
    assert many.count() == 2 and "LeftSemi" in plan(many)
    with pytest.raises(ValueError):
        by_ids(stored, [], "file_id")


def test_metadata_filter_reads_metadata(spark):
    frame = spark.createDataFrame([("1", {"lang": "en"}, "x", "n"), ("2", {"lang": "fr"}, "y", "n"), ("3", None, "x", "n")],
                                  "id string, metadata map<string,string>, team string, namespace string")
    assert rows(with_metadata(frame, {"lang": "en"}).select("id")) == [("1",)]
    assert rows(with_metadata(frame, {"team": "x", "lang": "en"}, {"team": "team"}).select("id")) == [("1",)]
    assert with_metadata(frame, {"team": "x"}).count() == 0 and with_metadata(frame, {"id": "1"}).count() == 0
    assert in_namespace(frame, "other").count() == 0


def test_names(spark):
    assert one(spark, extension("f"), f="a.b.PDF") == "pdf"
    assert one(spark, extension("f"), f="README") == "readme"
    assert one(spark, decode_utf8(F.lit(bytearray(b"\xc3\xa9"))), f="") == "é"
    assert one(spark, decode_utf8(F.lit(bytearray(b"\xff"))), f="") is None
    first = one(spark, stable_uuid(F.col("a"), F.col("b")), a="1", b="2")
    assert len(first) == 36 and first == one(spark, stable_uuid(F.col("a"), F.col("b")), a="1", b="2")


def test_times_do_not_depend_on_where_they_are_logged(spark):
    ts = F.timestamp_seconds(F.lit(1711015200))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, log_key(F.col("a"), ts), a="7") == "7/2024-03-21T10:00:00Z.txt"
        assert one(spark, table_time(ts), a="") == "2024-03-21 19:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_maps(spark):
    frame = spark.createDataFrame([({"a": "1", "b": None}, {"b": "2", "c": None}), (None, {"x": "1"}), ({"x": "1"}, None)],
                                  "l map<string,string>, r map<string,string>")
    got = [r[0] for r in frame.select(merge(F.col("l"), F.col("r"))).collect()]
    assert got == [{"a": "1", "b": "2", "c": None}, {"x": "1"}, {"x": "1"}]
    assert frame.select(fill_nulls(F.col("l"))).first()[0] == {"a": "1", "b": ""}


def test_require_valid_specs(spark):
    good = spark.createDataFrame([(0, '{"file_path": [{"/a": {"metadata": {}}}], "collection_name": "c"}')],
                                 "entry_idx int, spec string")
    q.require_valid_specs(good)
    with pytest.raises(ValueError, match="file_path missing in entry 1"):
        q.require_valid_specs(good.union(spark.createDataFrame([(1, '{"collection_name": "c"}')], good.schema)))
