import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from docweave.operators.reports import failure_counts, observed_outcomes
from docweave.plans.changelog import ChangeLog
from docweave.plans.file_etl import load_vectors, process_files, replaced_chunks, run_file_etl
from docweave.plans.method_sync import sync_methods
from docweave.schemas import FILE_METADATA, METHOD_METADATA
from docweave.sources import files as source
from docweave.sources.messages import message_stream
from docweave.sources.tables import method_records
from docweave.streaming.jobs import (
    apply_file_messages, apply_method_messages, file_tables, method_tables, start_file_job, start_method_job)
from test_files import put

def run_time():
    return F.to_timestamp(F.lit("2024-05-01 00:00:00"))


def file_table(spark, *names, category="team.docs"):
    return spark.createDataFrame(
        [(f"f{i}", "p", n, f"/in/{n}", category, "1", "2024-03-21T10:00:00Z", "2024-03-21T10:00:00Z", "u",
          "document", n.split(".")[-1], "m", "1.0") for i, n in enumerate(names)],
        ", ".join(f"{n} string" for n in FILE_METADATA.names))


def methods(spark, *data):
    frame = spark.createDataFrame(list(data), "method_id string, content string")
    return method_records(frame.select("method_id", F.lit("name").alias("method_name"), F.lit("s").alias("segment"),
                                       F.lit("c").alias("category"), F.lit("me").alias("created_by"),
                                       F.lit(None).cast("string").alias("updated_by"), "content"))


def messages(spark, *values):
    return spark.createDataFrame([(f"m{i}", v) for i, v in enumerate(values)], "message_id string, value string")


def test_file_etl_isolates_failures(spark, tmp_path):
    put(tmp_path, "in/a.txt", "word " * 500)
    put(tmp_path, "in/b.txt", "  \n ")
    put(tmp_path, "in/c.csv", "h\ngood\nBAD\n")
    put(tmp_path, "in/d.pdf", b"x")

    def factory():
        def model(texts):
            if any("BAD" in t for t in texts):
                raise RuntimeError("no")
            return [[1.0, 2.0]] * len(texts)
        return model

    done = run_file_etl(file_table(spark, "a.txt", "b.txt", "c.csv", "d.pdf", "e.txt"), str(tmp_path),
                        model_factory=factory, dim=2, target="collection")
    outcome = {r.file_id: (r.chunks, r.stage, r.error) for r in done.outcomes.collect()}
    assert outcome == {
        "f0": (3, None, None), "f1": (0, "split", "no text in file"), "f2": (2, "embed", "RuntimeError: no"),
        "f3": (0, "read", "no extractor for pdf"), "f4": (0, "read", "file not found, empty or too large")}
    vectors = done.vectors.collect()
    assert len(vectors) == 3 and {v.namespace for v in vectors} == {"teamdocs"}
    assert sum(len(v.content.replace(" ", "")) for v in vectors) == 2000
    assert vectors[0].metadata["full_path"] == "/in/a.txt" and vectors[0].metadata["created_at"] is not None
    again = run_file_etl(file_table(spark, "a.txt"), str(tmp_path), model_factory=factory, dim=2)
    assert {v.id for v in again.vectors.collect()} == {v.id for v in vectors}
    assert again.vectors.first().namespace == "team_docs"


def test_outcomes_are_counted_on_the_way(spark, tmp_path):
    for name in ("a.txt", "b.txt"):
        put(tmp_path, f"in/{name}", "word " * 50)
    put(tmp_path, "in/c.txt", " ")
    catalogue = file_table(spark, "a.txt", "b.txt", "c.txt", "d.txt", "e.pdf")
    log, told = file_tables(spark, str(tmp_path / "tables")), []
    for _ in range(2):  # a batch that is run again is not published, nor counted
        apply_file_messages(messages(spark, "f0,f1,f2,f3"), 0, log, catalogue, str(tmp_path),
                            on_counts=lambda *seen: told.append(seen), dim=4)
    assert told == [(0, {"ok": 2, "failed": 2, "failed_read": 1, "failed_split": 1, "failed_embed": 0})]
    report = failure_counts(log.current("outcomes")).agg(F.sum("ok"), F.sum("failed")).first()
    assert tuple(report) == (2, 2)
    nothing = run_file_etl(catalogue.where("file_id = 'none'"), str(tmp_path), dim=4)
    assert nothing.counts["ok"] == nothing.counts["failed"] == 0


def test_counting_adds_no_scan(spark, tmp_path):
    frame = spark.createDataFrame([("1", None, None), ("2", "boom", "read")], "file_id string, error string, stage string")
    outcomes, seen = observed_outcomes(frame.repartition(3))
    assert "CollectMetrics" in plan(outcomes)
    outcomes.write.parquet(str(tmp_path / "outcomes"))
    spark.sparkContext.setJobGroup("counting", "")
    assert seen.get == {"ok": 1, "failed": 1, "failed_read": 1, "failed_split": 0, "failed_embed": 0}
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("counting")
    spark.sparkContext._jsc.clearJobGroup()


def test_file_etl_one_file_with_most_of_the_text(spark):
    big = "\n".join(f"line {i} " + "x" * 80 for i in range(4000))
    data = file_table(spark, "big.txt", *[f"s{i}.txt" for i in range(20)])
    bodies = data.withColumn("body", F.when(F.col("filename") == "big.txt", F.lit(big)).otherwise("small").cast("binary"))
    done = process_files(bodies, dim=8)
    chunks = {r.file_id: r.chunks for r in done.outcomes.collect()}
    assert sum(chunks.values()) == done.vectors.count() and chunks["f0"] > 300 and chunks["f5"] == 1


def test_sync_keeps_creation_and_replaces_vectors(spark):
    state = spark.createDataFrame(
        [("1", "old-1", "n", "s", "c", "d", "u", None, None, None)], METHOD_METADATA
    ).withColumn("vector_created_at", F.to_timestamp(F.lit("2020-01-01 00:00:00")))
    done = sync_methods(messages(spark, "1, 2", "2", "3,x", "99"), methods(spark, ("1", "one"), ("2", "two"), ("3", "three")),
                        state, run_time(), 5, dim=8)
    found = {r.method_id: r for r in done.metadata.collect()}
    assert sorted(found) == ["1", "2"]
    assert str(found["1"].vector_created_at)[:4] == "2020" or found["1"].vector_created_at.year in (2019, 2020)
    assert found["1"].vector_updated_at is not None and found["2"].vector_updated_at is None
    assert rows(done.old_vectors) == [("default", "old-1")]
    assert {v.id for v in done.vectors.collect()} == {r.uuid for r in found.values()}
    meta = {v.content: v.metadata for v in done.vectors.collect()}
    assert meta["one"]["vectorCreatedAt"] == "2020-01-01 00:00:00" and meta["one"]["vectorUpdatedAt"] == "2024-05-01 00:00:00"
    assert meta["two"]["vectorUpdatedAt"] == "" and meta["two"]["updated_by"] == ""
    assert rows(done.rejects.select("message_id", "reason")) == [
        ("m2", "ids are not numeric: x"), ("m3", "no matching data")]


def counting_scans(frame):
    """`frame`, and an accumulator that counts the rows each run of it reads."""
    read = frame.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return frame.mapInArrow(run, frame.schema), read


def test_a_batch_of_messages_reads_the_records_once(spark, tmp_path):
    data = [(str(i), f"text {i}") for i in range(20)]
    records, read = counting_scans(methods(spark, *data))
    log = method_tables(spark, str(tmp_path))
    assert apply_method_messages(messages(spark, "1,2,3", "99", "4,x"), 0, log, records, dim=4)
    assert read.value == 20
    assert apply_method_messages(messages(spark, "2", "98"), 1, log, records, dim=4)
    assert read.value == 40
    assert rows(log.current("methods").select("method_id", F.col("vector_updated_at").isNotNull())) == [
        ("1", False), ("2", True), ("3", False)]
    # Messages are named alike in both batches, so their rejections are too.
    assert rows(log.current("rejects").select("message_id", "reason")) == [
        ("m1", "no matching data"), ("m2", "ids are not numeric: x")]


def test_sync_of_odd_rows(spark):
    records = methods(spark, ("1", "one"), ("1", "one"), ("2", None), ("3", ""), (None, "no id"), ("4", "not asked for"))
    state = spark.createDataFrame(
        [(i, u, "n", "s", "c", "d", "u", None, None, None) for i, u in (("1", "old-1"), ("4", "old-4"), (None, "old"))],
        METHOD_METADATA)
    asked = spark.createDataFrame(
        [("a", " 1 ,3,1"), ("a", "77"), ("b", "2"), ("c", None), ("d", ""), (None, "78"), ("e", "1,,3")],
        "message_id string, value string")
    for known in (state, lambda wanted: state.join(wanted, "method_id", "left_semi")):
        done = sync_methods(asked, records, known, run_time(), 5, dim=4)
        assert rows(done.metadata.select("method_id", "description", F.col("vector_updated_at").isNotNull())) == [
            ("1", "one", True), ("3", "", False)]
        assert rows(done.old_vectors) == [("default", "old-1")] and done.vectors.count() == 2
        assert rows(done.rejects) == sorted([
            (None, "2", "cannot embed: text is null"), (None, None, "no matching data"),
            ("c", None, "ids are not numeric: "), ("d", None, "ids are not numeric: "), ("e", None, "ids are not numeric: ")],
            key=lambda r: tuple(map(str, r)))
    nothing = sync_methods(asked.limit(0), records, state, run_time(), 5, dim=4)
    assert nothing.metadata.count() == nothing.vectors.count() == nothing.old_vectors.count() == nothing.rejects.count() == 0


def test_method_that_cannot_be_embedded_changes_nothing(spark):
    def factory():
        def model(texts):
            if "bad" in texts:
                raise RuntimeError("no")
            return [[1.0]] * len(texts)
        return model

    state = spark.createDataFrame([("2", "old-2", "n", "s", "c", "d", "u", None, None, None)], METHOD_METADATA)
    done = sync_methods(messages(spark, "1,2"), methods(spark, ("1", "fine"), ("2", "bad")), state, run_time(), 1,
                        model_factory=factory, dim=1)
    assert rows(done.metadata.select("method_id")) == [("1",)] and done.old_vectors.count() == 0
    assert rows(done.rejects.select("method_id", "reason")) == [("2", "cannot embed: RuntimeError: no")]


KV = "k string, v string"


def log_of(spark, path):
    schema = spark.createDataFrame([], KV).schema
    return ChangeLog(spark, str(path), {"t": (schema, ["k"]), "u": (schema, ["k"])})


def test_change_log(spark, tmp_path):
    log = log_of(spark, tmp_path)
    frame = lambda *data: spark.createDataFrame(list(data), KV)
    keys = lambda *data: spark.createDataFrame([(k,) for k in data], "k string")
    assert log.current("t").count() == 0 and log.last_batch() is None
    log.compact()
    assert log.publish(0, {"t": (frame(("a", "1"), ("b", "1"), (None, "1")), None), "u": (frame(("z", "1")), None)})
    assert log.publish(1, {"t": (frame(("a", "2"), ("c", "2")), keys("b", "a", "nope"))})
    expected = [("a", "2"), ("c", "2"), (None, "1")]
    assert rows(log.current("t"), ) == sorted(expected, key=lambda r: tuple(map(str, r)))
    assert not log.publish(1, {"t": (frame(("a", "replayed")), None)})
    # A batch that was written but never committed is not seen, and can be written again.
    (frame(("a", "lost")).withColumn("_deleted", F.lit(False)).write
     .parquet(str(tmp_path / "changes" / "t" / "batch_id=2")))
    assert len(rows(log.current("t"))) == 3 and ("a", "2") in rows(log.current("t"))
    log.compact()
    assert set(rows(log.current("t"))) == set(expected) and rows(log.current("u")) == [("z", "1")]
    assert log.publish(2, {"t": (frame(("d", "3"), (None, "3")), keys("c"))})
    assert set(rows(log.current("t"))) == {("a", "2"), ("d", "3"), (None, "3")}
    log.compact()
    assert set(rows(log_of(spark, tmp_path).current("t"))) == {("a", "2"), ("d", "3"), (None, "3")}


def test_unique_rows_are_published_from_one_scan(spark, tmp_path):
    log = log_of(spark, tmp_path)
    made, read = counting_scans(spark.createDataFrame([("a", "1"), ("b", "1"), (None, "1")], KV))
    keys = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "k string")
    other = spark.createDataFrame([("c", "0"), ("d", "0")], KV)
    assert log.publish(0, {"t": (other, None), "u": (other, None)}, unique=("t",))
    assert log.publish(1, {"t": (made, keys), "u": (made.limit(0), None)}, unique=("t",))
    assert read.value == 3
    # Deleted and upserted in one batch, null keys too: the row stays, before and after a fold.
    want = {("a", "1"), ("b", "1"), (None, "1"), ("d", "0")}
    assert set(rows(log.current("t"))) == want and len(rows(log.current("t"))) == 4
    log.compact()
    assert set(rows(log.current("t"))) == want and log.current("u").count() == 2
    assert log.publish(2, {"t": (other.limit(0), keys)}, unique=("t",))
    assert set(rows(log.current("t"))) == {("b", "1"), ("d", "0")}


def test_the_last_batch_is_told_without_a_job(spark, tmp_path):
    log, context = log_of(spark, tmp_path / "batch_id=99"), spark.sparkContext
    frame = spark.createDataFrame([("a", "1")], KV)
    assert log.last_batch() is None
    for batch in (9, 10, 11):
        assert log.publish(batch, {"t": (frame, None)})
    context.setJobGroup("last", "")
    assert log.last_batch() == 11 and log._last("base") is None
    assert not context.statusTracker().getJobIdsForGroup("last")
    context._jsc.clearJobGroup()
    assert not log.publish(10, {"t": (frame, None)}) and rows(log.current("t")) == [("a", "1")]


def parquet_files(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_a_fold_rewrites_only_what_changed(spark, tmp_path):
    schema = "k string, n string, v string"
    log = ChangeLog(spark, str(tmp_path), {"t": (spark.createDataFrame([], schema).schema, ["n", "k"], ["n"])})
    data = {(f"k{i}", f"a{i % 4}" if i % 7 else None): "0" for i in range(200)}

    def publish(batch, changed, gone=()):
        data.update(dict.fromkeys(changed, str(batch)))
        for key in gone:
            del data[key]
        upserts = spark.createDataFrame([(k, n, str(batch)) for k, n in changed], schema)
        assert log.publish(batch, {"t": (upserts, spark.createDataFrame(list(gone), "k string, n string") if gone else None)})

    def check():
        assert set(rows(log.current("t"))) == {(k, n, v) for (k, n), v in data.items()}

    publish(0, list(data))
    log.compact()
    before = parquet_files(tmp_path / "base")
    # One namespace changes: a new key, a changed one, and all that another place held go.
    n1 = [key for key in data if key[1] == "a1"]
    publish(1, [("new", "a1"), n1[0]], n1[1:])
    check()
    log.compact()
    check()
    after = parquet_files(tmp_path / "base")
    assert all(after[f] == t for f, t in before.items())
    added = set(after) - set(before)
    assert added and all("/n=a1/" in f for f in added)
    # A table without changes is not written; only the list of its places is.
    publish(2, [("x", None)], [("new", "a1"), n1[0]])
    log.compact()
    check()
    assert len(set(parquet_files(tmp_path / "base")) - set(after)) == 1
    publish(3, [])
    log.compact()
    assert len(parquet_files(tmp_path / "base")) == len(after) + 1
    check()
    # Nothing of namespace a1 is left, so the version that held its rows can go.
    log.remove_unread()
    assert not parquet_files(tmp_path / "changes")
    check()
    # Once all places have a newer version, the first one goes.
    assert any("/batch_id=0/" in f for f in parquet_files(tmp_path / "base"))
    publish(4, list(data))
    log.compact()
    log.remove_unread()
    check()
    left = parquet_files(tmp_path / "base")
    assert left and not any("/batch_id=0/" in f for f in left)


def test_a_failed_fold_leaves_the_tables(spark, tmp_path, monkeypatch):
    log = log_of(spark, tmp_path)
    frame = lambda *data: spark.createDataFrame(list(data), KV)
    log.publish(0, {"t": (frame(*[(f"k{i}", "0") for i in range(50)]), None)})
    log.compact()
    log.publish(1, {"t": (frame(("k1", "1")), spark.createDataFrame([("k2",)], "k string"))})
    want = set(rows(log.current("t")))
    with monkeypatch.context() as broken:
        broken.setattr(ChangeLog, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log.compact()
    assert set(rows(log.current("t"))) == want and len(want) == 49
    log.publish(2, {"t": (frame(("k3", "2")), None)})
    log.compact()
    assert set(rows(log.current("t"))) == {(k, "2" if k == "k3" else v) for k, v in want}


def test_partition_columns_are_part_of_the_key(spark, tmp_path):
    with pytest.raises(ValueError, match="key columns"):
        ChangeLog(spark, str(tmp_path), {"t": (spark.createDataFrame([], "k string, n string").schema, ["k"], ["n"])})


def test_failed_publish_changes_no_table(spark, tmp_path):
    log = log_of(spark, tmp_path)
    good = spark.createDataFrame([("a", "1")], KV)
    bad = good.withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        log.publish(0, {"t": (good, None), "u": (bad, None)})
    assert log.current("t").count() == 0 and log.last_batch() is None
    assert log.publish(0, {"t": (good, None), "u": (good, None)}) and log.current("t").count() == 1


def test_file_stream_with_restart_and_replay(spark, tmp_path):
    put(tmp_path, "store/in/a.txt", "alpha one")
    put(tmp_path, "store/in/b.txt", "beta two")
    put(tmp_path, "queue/1", "f0, f9")
    files = file_table(spark, "a.txt", "b.txt")
    log = file_tables(spark, str(tmp_path / "tables"))
    queue = lambda: message_stream(spark, str(tmp_path / "queue"))

    def run():
        start_file_job(queue(), log, files, str(tmp_path / "store"), str(tmp_path / "mark"), True, dim=8).awaitTermination(120)

    run()
    assert rows(log.current("vectors").select("content")) == [("alpha one",)]
    put(tmp_path, "store/in/a.txt", "alpha changed")
    put(tmp_path, "queue/2", "f0,f1")
    run()
    expected = [("alpha changed",), ("beta two",)]
    assert rows(log.current("vectors").select("content")) == expected
    before = rows(log.current("vectors").select("id", "content"))
    replayed = spark.createDataFrame([("x", "f0,f1")], "message_id string, value string")
    assert apply_file_messages(replayed, 1, log, files, str(tmp_path / "store"), dim=8) is False
    assert apply_file_messages(replayed, 2, log, files, str(tmp_path / "store"), dim=8)
    assert rows(log.current("vectors").select("id", "content")) == before
    assert rows(log.current("outcomes").select("file_id", "error")) == [("f0", None), ("f1", None)]


def test_method_stream_inserts_then_updates(spark, tmp_path):
    records = methods(spark, ("1", "one"), ("2", "two"))
    log = method_tables(spark, str(tmp_path / "tables"))
    put(tmp_path, "queue/1", "1,2")
    put(tmp_path, "queue/2", "1,x")

    def run():
        queue = message_stream(spark, str(tmp_path / "queue"))
        start_method_job(queue, log, records, str(tmp_path / "mark"), True, dim=8).awaitTermination(120)

    run()
    first = {r.method_id: r for r in log.current("methods").collect()}
    assert sorted(first) == ["1", "2"] and first["1"].vector_updated_at is None
    assert log.current("vectors").count() == 2 and log.current("rejects").count() == 1
    put(tmp_path, "queue/3", "2")
    run()
    second = {r.method_id: r for r in log.current("methods").collect()}
    assert second["1"] == first["1"] and second["2"].uuid != first["2"].uuid
    assert second["2"].vector_created_at == first["2"].vector_created_at and second["2"].vector_updated_at is not None
    assert {r.id for r in log.current("vectors").collect()} == {r.uuid for r in second.values()}
    # A batch that is already published is skipped, so an insert stays an insert.
    assert apply_method_messages(messages(spark, "1"), 0, log, records, dim=8) is False


def test_csv_files_of_a_store(spark, tmp_path):
    for n, name in enumerate(("a 1.csv", "b+2.csv", "c%20.csv")):
        head = "id,text" if n < 2 else "key , note"
        put(tmp_path, "in/" + name, head + "\n" + "".join(f'{i},"say ""{n}-{i}"""\n' for i in range(40))
            + ("7\n8,x,y,z\n" if n == 1 else ""))
    put(tmp_path, "in/d.csv", "id,text\n")
    done = run_file_etl(file_table(spark, "a 1.csv", "b+2.csv", "c%20.csv", "d.csv"), str(tmp_path), dim=4)
    assert done.vectors.count() == 122
    assert [r[-1] for r in rows(done.outcomes)] == [None, None, None, "no documents"]


def test_csv_files_above_every_limit_are_streamed(spark, tmp_path, monkeypatch):
    lines = "".join(f'{i},"say ""{i}""\r\nor {i}",é\n' for i in range(300)) + "7\r8,x,y,z\n\n9,\r"
    bodies = {"a 1.csv": "id, text\n" + lines, "b+2.csv": "\ufeffkey,note\r\n" + lines, "c.CSV": "h,\xff\n" * 60,
              "d.csv": "only,a,header," + "x" * 200 + "\n"}
    for name, body in bodies.items():
        put(tmp_path, "in/" + name, body.encode("latin-1" if name == "c.CSV" else "utf-8"))
    put(tmp_path, "in/e.csv", "h\nsmall\n")
    put(tmp_path, "in/f.txt", "word " * 30)
    put(tmp_path, "in/g.txt", "word " * 100)
    data = file_table(spark, *bodies, "e.csv", "f.txt", "g.txt")

    def found(done):
        return rows(done.vectors.drop("embedding").withColumn("metadata", F.to_json("metadata")))

    small = run_file_etl(data, str(tmp_path), dim=4)
    want, outcomes = found(small), {r.file_id: r for r in small.outcomes.collect()}
    monkeypatch.setattr(source, "CSV_ROW_BYTES", 100, raising=False)
    monkeypatch.setattr(source, "MAX_FILE_BYTES", 200)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    try:
        done = run_file_etl(data, str(tmp_path), dim=4)
        got, now = found(done), {r.file_id: r for r in done.outcomes.collect()}
        loaded = load_vectors(spark, str(tmp_path / "in"), dim=4)
        assert loaded.vectors.count() == len(got)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # Only the text above the limit for one row is left out.
    assert got == [r for r in want if '"file_id":"f6"' not in str(r)] and len(got) > 600
    assert now.pop("f6").error == "file not found, empty or too large" and outcomes.pop("f6").error is None
    assert now.pop("f2").error.startswith("UnicodeDecodeError") and outcomes.pop("f2").error.startswith("UnicodeDecodeError")
    assert now == outcomes and now["f3"].error == "no documents"


def test_namespaces_paths_and_stored_chunks(spark, tmp_path):
    put(tmp_path, "in/a.txt", "word " * 500)
    put(tmp_path, "in/b.csv", "h\n" + "long text " * 150 + "\nshort\n")
    data = file_table(spark, "a.txt", "b.csv", category=None)
    again = data.where("file_id = 'f0'").withColumn("file_id", F.lit("f9"))
    done = run_file_etl(data.unionByName(again).unionByName(again), str(tmp_path), dim=4)
    assert {v.namespace for v in done.vectors.collect()} == {"default"}
    ids = [v.id for v in done.vectors.collect()]
    assert len(ids) == len(set(ids))
    assert {r.file_id: r.error for r in done.outcomes.collect()} == {
        "f0": None, "f1": None, "f9": "path is listed more than once"}
    # As many keys as chunks were stored.
    assert {r.id for r in replaced_chunks(done.stored, done.stored).collect()} == set(ids)
    assert replaced_chunks(done.stored, done.stored).count() == len(ids)
    assert rows(done.places) == [("default",)]


def test_paths_to_vectors_without_a_catalogue(spark, tmp_path):
    put(tmp_path, "in/a.txt", "alpha one")
    put(tmp_path, "in/b.csv", "h\nx\ny\n")
    put(tmp_path, "in/c.zip", "?")
    done = load_vectors(spark, str(tmp_path / "in"), "papers", dim=4)
    assert rows(done.vectors.select("namespace", "content")) == [("papers", "alpha one"), ("papers", "h: x"), ("papers", "h: y")]
    assert sum(r.error is not None for r in done.outcomes.collect()) == 1
    assert {v.namespace for v in load_vectors(spark, str(tmp_path / "in"), dim=4).vectors.collect()} == {"default"}


def test_records_that_break_rules_are_not_read(spark, tmp_path):
    put(tmp_path, "store/in/a.txt", "alpha")
    put(tmp_path, "store/in/b.txt", "beta")
    files = file_table(spark, "a.txt", "b.txt").withColumn(
        "size_bytes", F.when(F.col("file_id") == "f1", "-1").otherwise(F.col("size_bytes")))
    log = file_tables(spark, str(tmp_path / "tables"))
    assert apply_file_messages(messages(spark, "f0,f1"), 0, log, files, str(tmp_path / "store"), dim=4, target="collection")
    assert rows(log.current("outcomes").select("file_id", "error")) == [("f0", None), ("f1", "broken rules: size_bytes_negative")]
    assert rows(log.current("collections").select("name", "type")) == [("teamdocs", "Document")]
    assert apply_file_messages(messages(spark, "f0"), 1, log, files, str(tmp_path / "store"), dim=4, target="collection")
    assert log.current("collections").count() == 1 and log.current("vectors").count() == 1


def test_wanted_rows_are_picked_before_the_window(spark, tmp_path):
    log = log_of(spark, tmp_path)
    frame = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], KV)
    log.publish(0, {"t": (frame, None)})
    assert log.current("t").count() == 2
    log.publish(1, {"t": (frame.where("k = 'b'").withColumn("v", F.lit("3")), None)})
    log.compact()
    log.publish(2, {"t": (frame.where("k = 'a' and v = '2'"), None)})
    found = log.current("t", spark.createDataFrame([("b",)], "k string"))
    assert rows(found) == [("b", "3")]
    text = plan(found).split("== Physical Plan ==")[1]
    assert "LeftSemi" in text.split("Window ")[1]


def test_published_vectors_are_pruned_by_namespace(spark, tmp_path, capsys):
    from conftest import formatted_plan
    from docweave.operators.selection import in_namespace
    log = file_tables(spark, str(tmp_path / "tables"))
    vectors = spark.createDataFrame(
        [("1", [1.0], "a", None, "n1"), ("2", [1.0], "b", None, "n2")], log.tables["vectors"][0])
    empty = {n: (spark.createDataFrame([], log.tables[n][0]), None) for n in ("outcomes", "stored", "collections")}
    log.publish(0, {"vectors": (vectors, None), **empty})
    log.compact()
    log.publish(1, {"vectors": (vectors.where("id = '1'"), None), **empty})
    found = in_namespace(log.current("vectors"), "n1")
    assert rows(found.select("id")) == [("1",)]
    # The changed keys, which are narrow, are read whole; both scans of rows are pruned.
    filters = [x for x in formatted_plan(found, capsys).splitlines() if x.startswith("PartitionFilters")]
    assert sum("= n1)" in x for x in filters) == 2 and len(filters) == 3


def test_staged_tables_are_removed_with_their_scope(spark, tmp_path):
    import os
    from docweave.session import stage, staging_scope
    kept = stage(spark.range(3), "kept")
    with staging_scope(spark):
        inner = stage(kept.where("id > 0"), "inner")
        path = inner.inputFiles()[0].removeprefix("file://")
        assert inner.count() == 2 and os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path)) and kept.count() == 3
    log = method_tables(spark, str(tmp_path))
    folder = os.path.dirname(os.path.dirname(path))
    before = set(os.listdir(folder))
    assert apply_method_messages(messages(spark, "1"), 0, log, methods(spark, ("1", "one")), dim=4)
    assert set(os.listdir(folder)) == before and log.current("methods").count() == 1
