import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan, rows
from docweave.operators import mutations as m
from docweave.operators.batching import fixed_batches, number_rows
from docweave.operators.reports import failed_files, failure_counts, failure_messages, list_collections


def people(spark, *data):
    return spark.createDataFrame(list(data), "k string, a string, b string")


def test_update_overwrites_with_null_and_ignores_unknown_keys(spark):
    current = people(spark, ("1", "x", "y"), ("2", "x", "y"), (None, "x", "y"))
    changes = spark.createDataFrame([("1", None), ("9", "z")], "k string, a string")
    assert rows(m.update(current, changes, ["k"])) == [("1", None, "y"), ("2", "x", "y"), (None, "x", "y")]
    with pytest.raises(ValueError):
        m.update(current, changes.withColumnRenamed("a", "zzz"), ["k"])


def test_delete_keeps_null_keys(spark):
    current = people(spark, ("1", "x", "y"), (None, "x", "y"))
    gone = spark.createDataFrame([("1",), (None,)], "k string")
    assert rows(m.delete(current, gone, ["k"])) == [(None, "x", "y")]


def test_chain_applies_in_order(spark):
    current = people(spark, ("1", "x", "y"))
    end = m.chain(current, lambda c: m.insert(c, people(spark, ("2", "p", "q"))),
                  lambda c: m.delete(c, spark.createDataFrame([("1",)], "k string"), ["k"]))
    assert rows(end) == [("2", "p", "q")]


def test_latest_per_key(spark):
    changes = spark.createDataFrame([("1", 1, "old"), ("1", 3, None), ("2", 1, "only")], "k string, n int, v string")
    assert rows(m.latest_per_key(changes, ["k"], ["n"])) == [("1", 3, None), ("2", 1, "only")]


KEYS = st.lists(st.integers(0, 6), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(KEYS, KEYS)
def test_upsert_and_delete_laws(spark, old, new):
    current = spark.createDataFrame([(str(k), "old") for k in set(old)], "k string, v string")
    change = spark.createDataFrame([(str(k), "new") for k in set(new)], "k string, v string")
    once = m.upsert(current, change, ["k"])
    assert rows(once) == sorted((str(k), "new" if k in new else "old") for k in set(old) | set(new))
    assert rows(m.upsert(once, change, ["k"])) == rows(once)
    fresh = change.join(current, "k", "left_anti")
    assert rows(m.delete(m.insert(current, fresh), fresh, ["k"])) == rows(current)


VECTOR = "id string, embedding array<float>, content string, metadata map<string,string>, namespace string"


def vectors(spark):
    return spark.createDataFrame([("1", [1.0], "one", {"a": "1", "b": "1"}, "n1"), ("1", [2.0], "two", None, "n2"),
                                  ("2", [3.0], "three", {"a": "3"}, "n1")], VECTOR)


def test_vectors_are_keyed_by_namespace_and_id(spark):
    new = spark.createDataFrame([("1", [9.0], "new", None, "n2"), ("5", [5.0], "new", None, None)], VECTOR)
    after = m.upsert_vectors(vectors(spark), new).select("namespace", "id", "content")
    assert rows(after) == [("default", "5", "new"), ("n1", "1", "one"), ("n1", "2", "three"), ("n2", "1", "new")]
    assert rows(m.delete_vectors(vectors(spark), ["1"], "n1").select("namespace", "id")) == [("n1", "2"), ("n2", "1")]
    with pytest.raises(ValueError):
        m.delete_vectors(vectors(spark), [])


def test_update_vectors_merges_metadata(spark):
    changes = spark.createDataFrame(
        [("n1", "1", [7.0], {"b": "2", "c": "2"}), ("n1", "2", [8.0], None), ("n1", "77", [0.0], None)],
        "namespace string, id string, embedding array<float>, metadata map<string,string>")
    after = {(r.namespace, r.id): r for r in m.update_vectors(vectors(spark), changes).collect()}
    assert after["n1", "1"].metadata == {"a": "1", "b": "2", "c": "2"} and list(after["n1", "1"].embedding) == [7.0]
    assert after["n1", "2"].metadata == {"a": "3"} and list(after["n1", "2"].embedding) == [8.0]
    assert list(after["n2", "1"].embedding) == [2.0] and len(after) == 3


def test_namespaces_and_collections(spark):
    assert rows(m.delete_namespace(vectors(spark), "n1").select("id")) == [("1",)]
    for name in ("nope", ""):
        with pytest.raises(ValueError):
            m.delete_namespace(vectors(spark), name)
    empty = m.delete_all_namespaces(vectors(spark))
    assert empty.count() == 0 and empty.columns == vectors(spark).columns
    collections = spark.createDataFrame([("n1", None, "Image")], "name string, created_at timestamp, type string")
    wanted = spark.createDataFrame([("n1",), ("n3",), ("n3",), ("",)], "name string")
    made = m.get_or_create_collections(collections, wanted, F.lit(None).cast("timestamp"))
    assert rows(made) == [("n1", None, "Image"), ("n3", None, "Document")]
    left, names = m.delete_collection(vectors(spark), made, "n1")
    assert rows(left.select("namespace")) == [("n2",)] and rows(names.select("name")) == [("n3",)]


def test_one_change_per_key(spark):
    old = vectors(spark).select("namespace", "id", "embedding", "content", "metadata")
    twice = old.withColumn("v", F.lit(1)).unionByName(
        old.withColumns({"v": F.lit(2), "content": F.lit("second"), "embedding": F.array(F.lit(7.0).cast("float"))}))
    after = m.upsert_vectors(old, twice, order_by=["v"])
    assert after.columns == old.columns and after.count() == old.count()
    assert {r.content for r in after.collect()} == {"second"}
    assert m.upsert_vectors(old, twice.drop("v").withColumn("namespace", F.lit(None).cast("string"))).where(
        "namespace = 'default'").count() == old.select("id").distinct().count()
    updated = m.update_vectors(old, twice, order_by=["v"])
    assert updated.count() == old.count() and {tuple(r.embedding) for r in updated.collect()} == {(7.0,)}
    current = spark.createDataFrame([("1", "x"), ("2", "y")], "k string, a string")
    changes = spark.createDataFrame([("1", "p", 1), ("1", "q", 2), ("3", "z", 1)], "k string, a string, at int")
    assert rows(m.update(current, changes, ["k"], order_by=["at"])) == [("1", "q"), ("2", "y")]
    assert rows(m.upsert(current, changes.drop("at").where("k = '1'"), ["k"]))[1] == ("2", "y")


def test_small_changes_do_not_shuffle_the_table(spark, tmp_path):
    for name, frame in (("t", vectors(spark)), ("c", vectors(spark))):
        frame.write.parquet(str(tmp_path / name))
    table, change = (spark.read.parquet(str(tmp_path / n)) for n in "tc")
    text = plan(m.upsert_vectors(table, change, unique=True))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["hot", "hot", "hot", "cold", "x", None]), max_size=60), st.integers(1, 7),
       st.integers(1, 6))
def test_batches_per_group(spark, groups, size, partitions):
    data = [(g, i) for i, g in enumerate(groups)]
    frame = spark.createDataFrame(data, "g string, i int").repartition(3)
    got = sorted(map(tuple, fixed_batches(frame, size, ["i"], ["g"], partitions).collect()), key=str)
    seen, expected = {}, []
    for g, i in data:
        n = seen[g] = seen.get(g, -1) + 1
        expected.append((g, i, n // size, n % size))
    assert got == sorted(expected, key=str)


def test_global_numbers_over_many_tasks_and_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        frame = spark.range(0, 1000, 1, 5).select((F.col("id") * 37 % 1000).alias("x"))
        numbered = number_rows(frame, ["x"], partitions=6)
        assert numbered.where("x <> row_no").count() == 0 and numbered.count() == 1000
        hot = frame.select(F.when(F.col("x") < 700, "hot").otherwise("cold").alias("g"), "x")
        per_group = number_rows(hot, ["x"], ["g"], partitions=6)
        assert per_group.where("row_no <> if(g = 'hot', x, x - 700)").count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_batch_size_is_checked_when_the_plan_is_built(spark):
    for size in (0, -1, True, "3"):
        with pytest.raises(ValueError):
            fixed_batches(spark.range(3), size, ["id"])


def test_failure_report(spark):
    outcomes = spark.createDataFrame(
        [("1", "a", None), ("1", "a", "boom"), ("2", "a", None), ("3", "b", "boom"), ("3", "b", "boom")],
        "file_id string, category string, error string")
    assert rows(failure_counts(outcomes)) == [("a", 1, 1), ("b", 0, 1)]
    assert rows(failure_messages(outcomes)) == [("a", "boom", 1), ("b", "boom", 1)]
    assert rows(failed_files(outcomes)) == [("1",), ("3",)]


def test_first_collection_entry_wins(spark):
    entries = spark.createDataFrame([("c", 2, "B"), ("c", 1, "A")], "name string, created_at int, type string")
    assert rows(list_collections(entries)) == [("c", 1, "A")]


def test_update_texts(spark):
    changes = spark.createDataFrame(
        [("n1", "1", "new words", {"by": "me"}), ("n1", "2", "", None), ("n2", None, "text", None)],
        "namespace string, id string, text string, metadata map<string,string>")
    after, rejects = m.update_texts(vectors(spark), changes, dim=4)
    found = {(r.namespace, r.id): r for r in after.collect()}
    assert len(found["n1", "1"].embedding) == 4 and found["n1", "1"].metadata == {"a": "1", "b": "1", "by": "me"}
    assert list(found["n1", "2"].embedding) == [3.0]
    assert rows(rejects.select("reason")) == [("id is empty",), ("text is empty",)]
    assert rows(m.wrong_dimension(after, 1).select("namespace", "id")) == [("n1", "1")]


def test_merge_needs_a_table_format_that_supports_it(spark, tmp_path):
    table = f"merge_target_{tmp_path.name.replace('-', '_')}"
    people(spark, ("1", "x", "y")).write.option("path", str(tmp_path / "t")).saveAsTable(table)
    with pytest.raises(Exception, match="(?i)merge"):
        m.merge_into(people(spark, ("1", "p", "q")), table, ["k"])
    spark.sql(f"DROP TABLE {table}")


def test_ties_are_settled_alike_in_any_order(spark):
    """Rows of one key that differ only in a map: the same one stays, however they come."""
    from docweave.operators.mutations import one_per_key

    rows = [("k", {"a": str(i), "b": "x"}) for i in range(30)] + [("l", {"a": "1"}), (None, {}), (None, None)]
    kept = set()
    for turn in range(3):
        change = spark.createDataFrame(rows[turn:] + rows[:turn], "id string, metadata map<string,string>").repartition(turn + 1)
        kept.add(str(sorted((tuple(r) for r in one_per_key(change, ["id"]).collect()), key=str)))
    assert len(kept) == 1 and len(eval(next(iter(kept)))) == 3


def test_a_change_is_read_once(spark):
    from docweave.operators.mutations import upsert

    current = spark.createDataFrame([(i, "a") for i in range(5)], "id long, v string")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    change = spark.createDataFrame([(1, "x"), (1, "y"), (9, "z")], "id long, v string").mapInArrow(count, "id long, v string")
    from docweave.operators.mutations import one_per_key
    assert one_per_key(change, ["id"]).count() == 2 and seen.value == 3
    assert upsert(current, change, ["id"], ["v"]).where("id = 1").collect()[0]["v"] == "y"
