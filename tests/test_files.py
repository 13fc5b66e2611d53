import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from docweave.sources import files as source
from docweave.sources import tables


def put(root, name, body):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(body if isinstance(body, bytes) else body.encode())
    return str(path)


@pytest.fixture
def store(tmp_path):
    put(tmp_path, "d/a.csv", 'name, age \nAnn , 3\n"Bob\nJr",4,x,y\nCid\n')
    put(tmp_path, "d/b.txt", "é text")
    put(tmp_path, "d/c.MD", "# title")
    put(tmp_path, "d/e [1].json", '{ "b" : [1, 2.50, "x  \\" y"],\n "a": 1e400 }')
    put(tmp_path, "d/f.json", '"just  text"')
    put(tmp_path, "d/g.json", "{broken")
    put(tmp_path, "d/h.pdf", b"%PDF 1\n%PDF 2")
    put(tmp_path, "d/i.zip", b"zip")
    put(tmp_path, "d/j.txt", b"\xff\xfe")
    put(tmp_path, "d/k.csv", "a,b\n")
    put(tmp_path, "d/l.txt", "")
    return tmp_path


NAMES = ["a.csv", "b.txt", "c.MD", "e [1].json", "f.json", "g.json", "h.pdf", "i.zip", "j.txt", "k.csv", "l.txt", "missing.txt"]


def catalogue(spark):
    return spark.createDataFrame([("d/" + n,) for n in NAMES], "full_path string")


def by_name(df):
    out = {}
    for r in df.orderBy("full_path", "doc_no").collect():
        out.setdefault(r.full_path[2:], []).append((r.content, r.error))
    return out


def check_documents(found):
    assert found["a.csv"] == [("name: Ann\nage: 3", None), ("name: Bob\nJr\nage: 4\nNone: x,y", None),
                              ("name: Cid\nage: None", None)]
    assert found["b.txt"] == [("é text", None)] and found["c.MD"] == [("# title", None)]
    assert found["e [1].json"] == [('{"b":[1,2.50,"x  \\" y"],"a":1e400}', None)]
    assert found["f.json"] == [("just  text", None)]
    assert found["g.json"] == [(None, "not valid JSON")]
    assert found["i.zip"] == [(None, "unsupported format: zip")]
    assert found["j.txt"] == [(None, "not valid UTF-8")]
    assert found["k.csv"] == [(None, "no documents")]
    assert found["l.txt"] == found["missing.txt"] == [(None, "file not found, empty or too large")]
    assert sorted(found) == sorted(NAMES)


@pytest.mark.parametrize("listed", [1000, 2, 0])
def test_dispatch_over_real_files(spark, store, monkeypatch, listed):
    """Read path by path, by folder, and from the root."""
    monkeypatch.setattr(source, "MAX_LISTED_PATHS", listed)
    bodies = source.attach_bytes(catalogue(spark), str(store))
    found = by_name(source.file_documents(bodies))
    check_documents(found)
    assert found["h.pdf"] == [(None, "no extractor for pdf")]


def test_extractors(spark, store):
    bodies = source.attach_bytes(catalogue(spark), str(store))
    found = by_name(source.file_documents(bodies, {"PDF": lambda body: body.decode().split("\n"),
                                                   "zip": lambda body: 1 / 0}))
    assert found["h.pdf"] == [("%PDF 1", None), ("%PDF 2", None)]
    assert found["i.zip"] == [(None, "ZeroDivisionError: division by zero")]


def test_json_at_every_size(spark):
    long = "x" * 25_000_000
    texts = ['{"a": 1, "a": 2}', '{"a": NaN, "b": -Infinity}', "[1.50, 1E5]", '" top  level "', "{", "", f'["{long}"]']
    frame = spark.createDataFrame([(str(i), f"/{i}.json", t.encode()) for i, t in enumerate(texts)],
                                  "id string, full_path string, body binary")
    found = {r.id: (r.content, r.error) for r in source.file_documents(frame).collect()}
    assert [found[str(i)] for i in range(6)] == [
        ('{"a":1,"a":2}', None), ('{"a":NaN,"b":-Infinity}', None), ("[1.50,1E5]", None), (" top  level ", None),
        (None, "not valid JSON"), (None, "not valid JSON")]
    assert found["6"] == (f'["{long}"]', None)


def test_csv_headers(spark, tmp_path):
    frame = spark.createDataFrame([("/a.csv", b"a,a\n1,2\n"), ("/b.csv", b"x,y\n5,6\n"), ("/c.csv", b"h\n\xff\n")],
                                  "full_path string, body binary")
    found = {r.full_path: (r.content, r.error is None) for r in source.file_documents(frame).collect()}
    assert found == {"/a.csv": ("a: 2", True), "/b.csv": ("x: 5\ny: 6", True), "/c.csv": (None, False)}
    put(tmp_path, "u.csv", "a,b\n1,2\n")
    put(tmp_path, "v.csv", "x,y\n5,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        source.csv_documents(spark, [str(tmp_path / "u.csv"), str(tmp_path / "v.csv")]).collect()


def test_no_files_at_all(spark, tmp_path):
    bodies = source.attach_bytes(spark.createDataFrame([("nope.txt",)], "full_path string"), str(tmp_path))
    assert [(r.body, r.body_bytes) for r in bodies.collect()] == [(None, None)]
    assert source.attach_bytes(catalogue(spark).limit(0), str(tmp_path)).count() == 0


def test_inventory_does_not_read_contents(spark, store):
    listed = source.inventory(spark, str(store))
    text = plan(listed)
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in text
    found = {r.name.split("/")[-1]: r for r in listed.collect()}
    assert found["b.txt"]["size"] == 7 and found["b.txt"].content_type == "text/plain"
    assert found["i.zip"].content_type == "application/octet-stream" and found["c.MD"].content_type == "text/markdown"
    assert found["b.txt"].creation_time is None and found["b.txt"].last_modified is not None
    assert source.inventory(spark, str(store), "*.csv").count() == 2
    with pytest.raises(ValueError):
        source.inventory(spark, "")


def test_read_bytes_marks_files_that_are_too_large(spark, store, monkeypatch):
    monkeypatch.setattr(source, "MAX_FILE_BYTES", 7)
    found = {r.path.split("/")[-1]: r.content for r in source.read_bytes(spark, str(store / "d")).collect()}
    assert found["b.txt"] == "é text".encode() and found["h.pdf"] is None and len(found) == 10


@pytest.mark.parametrize("multiline", [True, False])
def test_csv_rows_are_numbered_per_file(spark, tmp_path, multiline):
    for f in range(3):
        put(tmp_path, f"in/{f}.csv", "id,text\n" + "".join(f"{i},row {i} of {f}\n" for i in range(500 + f)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    try:
        docs = source.csv_documents(spark, str(tmp_path / "in"), multiline)
        found = docs.select("content", F.col("metadata.source").alias("s"), F.col("metadata.row").alias("r")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found) == 1503
    for r in found:
        assert r.content == f"id: {r.r}\ntext: row {r.r} of {r.s.split('/')[-1][0]}"


def test_csv_quotes_and_empty_values(spark, tmp_path):
    path = put(tmp_path, "q.csv", 'a,b\n"x ""y""\nz",\n')
    assert [r.content for r in source.csv_documents(spark, path).collect()] == ['a: x "y"\nz\nb: ']


def test_write_table(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([("1", "n")], "id string, namespace string")
    tables.write_table(frame, path, partition_by=["namespace"])
    with pytest.raises(Exception, match="already exists"):
        tables.write_table(frame, path)
    tables.write_table(frame, path, overwrite=True)
    tables.append_records(frame, path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        tables.write_table(frame.limit(0), path, overwrite=True)


def test_export_texts(spark, tmp_path):
    frame = spark.createDataFrame([("1", "one"), ("2", "two")], "method_id string, content string")
    tables.export_texts(frame, str(tmp_path / "x"))
    assert rows(spark.read.text(str(tmp_path / "x"))) == [("one", 1), ("two", 2)]
    with pytest.raises(ValueError):
        tables.export_texts(frame, str(tmp_path / "y"), max_methods=1)


def test_query_parameters_are_values(spark):
    spark.createDataFrame([("x' OR '1'='1", 1), ("y", 2)], "k string, v int").createOrReplaceTempView("pairs")
    assert rows(tables.query(spark, "SELECT v FROM pairs WHERE k = :k", k="x' OR '1'='1")) == [(1,)]
    with pytest.raises(ValueError):
        tables.query(spark, " ")


def test_direct_readers(spark, store):
    texts = source.text_documents(spark, str(store), "*.txt")
    assert sorted(tuple(r)[::2] for r in texts.collect() if r.content) == [("é text", None)]
    assert [r.error for r in texts.where("content is null").collect()] == ["not valid UTF-8"]
    found = {r.metadata["source"].split("/")[-1]: (r.content, r.error)
             for r in source.json_documents(spark, str(store), "*.json").collect()}
    assert found["f.json"] == ("just  text", None) and found["g.json"] == (None, "not valid JSON")
    loaded = source.load_documents(spark, str(store), glob="*.csv").collect()
    assert sorted(((r.metadata["row"], r.error) for r in loaded), key=str) == [
        ("0", "no documents"), ("0", None), ("1", None), ("2", None)]


def test_run_log(spark, tmp_path):
    from docweave.operators.reports import run_log_latest
    path = str(tmp_path / "log")
    entries = spark.createDataFrame([("c", 0, 1, "first"), ("c", 0, 2, "second"), ("c", 1, 3, "third")],
                                    "chat_id string, s long, seq long, message string")
    entries = entries.select("chat_id", F.timestamp_seconds("s").alias("ts"), "seq", "message")
    tables.append_run_log(entries.where("seq < 3"), path)
    tables.append_run_log(entries.where("seq = 3"), path)
    assert rows(run_log_latest(spark.read.parquet(path)).select("name", "message")) == [
        ("c/1970-01-01T00:00:00Z.txt", "second"), ("c/1970-01-01T00:00:01Z.txt", "third")]


def test_outermost_folders():
    assert source._outermost(["/a/b", "/a", "/a-b", "/a/b/c", "/c"]) == ["/a-b", "/a", "/c"]


def csv_files(rng):
    """Files with quoted line breaks, quotes in odd places, records over many splits."""
    def cell():
        return rng.choice(['a', 'b c', '', '"x\ny"', '"q ""r"" s"', 'in"ner', '"a"b', ' "y"', 'é', '"\r\n"', '"' + "long\n" * 40 + '"'])

    files = {"plain.csv": "k,v\n" + "".join(f"{i},{i * i}\n" for i in range(900)),
             "header.csv": "k,v\n" + "\n" * 300, "open.csv": "k,v\n" + "1,2\n" * 80 + '"never closed\n' * 60,
             "head2.csv": '"k\nk","v ""w"""\n' + "1,2\n" * 100}
    for n in range(8):
        files[f"odd {n}.csv"] = rng.choice(["", "\ufeff"]) + '"k",v\n' + "".join(
            ",".join(cell() for _ in range(rng.randint(1, 3))) + rng.choice(["\n", "\r\n", "\n", "\r"]) for _ in range(150))
    return files


def test_large_csv_files_are_parsed_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source, "CSV_ROW_BYTES", 100)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "700")
    try:
        files, want = csv_files(random.Random(3)), []
        for name, text in files.items():
            (tmp_path / name).write_bytes(text.encode())
            rows = list(source._csv_rows(io.StringIO(text, newline="")))
            want += [(name, i, row, None) for i, row in enumerate(rows)] or [(name, 0, None, "no documents")]
        (tmp_path / "bad.csv").write_bytes(b"k,v\n" + b"1,2\n" * 300 + b"\xff,1\n" + b"3,4\n" * 300)
        listed = spark.createDataFrame([(n, f"{tmp_path}/{n}", 1000) for n in [*files, "bad.csv"]],
                                       "full_path string, location string, body_bytes long").withColumn(
            "body", F.lit(None).cast("binary"))
        out = source.large_csv_documents(listed)
        got = [(r["full_path"], r["doc_no"], r["content"], r["error"]) for r in out.collect()]
        bad = [r for r in got if r[0] == "bad.csv"]
        assert len(bad) == 1 and bad[0][1:3] == (0, None) and bad[0][3].startswith("UnicodeDecodeError")
        assert sorted(r for r in got if r[0] != "bad.csv") == sorted(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_states_of_quotes_equal_the_parser():
    rng = random.Random(8)
    for _ in range(5_000):
        line = "".join(rng.choice('ab",\r ') for _ in range(rng.randint(0, 12)))
        for inside in (False, True):
            # The parser is inside a field if a mark on the next line joins the last value.
            text = ('"' if inside else "") + ("\n" if inside else "") + line + "\n"
            last = list(csv.reader(io.StringIO(text + "mark,mark\n", newline="")))[-1]
            assert source._inside_after(line.encode(), inside) == (last != ["mark", "mark"]), (line, inside)


def test_no_file_stops_the_others(spark):
    def odd(body):
        return {b"1": ["\ud800"], b"2": [5], b"3": ["fine"], b"4": iter(["a", None])}[bytes(body)]

    rows = [(f"{i}.odd", str(i).encode()) for i in range(1, 5)]
    rows += [("s.json", b'"\\ud800"'), ("n.json", b'{"a": NaN}'), ("i.json", b" [" + b"9" * 5000 + b", 1.50]"), ("t.json", b' 7 '),
             ("u.json", b'{"a": "\\ud800"}'), ("q.json", b'"ok"')]
    files = spark.createDataFrame(rows, "full_path string, body binary")
    out = {(r["full_path"], r["doc_no"]): (r["content"], r["error"]) for r in source.file_documents(files, {"odd": odd}).collect()}
    assert out["1.odd", 0][0] is None and out["1.odd", 0][1].startswith("UnicodeEncodeError")
    assert out["2.odd", 0] == (None, "TypeError: an extractor gave int, not text")
    assert out["3.odd", 0] == ("fine", None) and out["4.odd", 0] == ("a", None)
    assert out["s.json", 0] == (None, "not valid JSON") and out["n.json", 0] == ('{"a":NaN}', None)
    assert out["i.json", 0] == ("[" + "9" * 5000 + ",1.50]", None) and out["t.json", 0] == ("7", None)
    assert out["u.json", 0] == ('{"a":"\\ud800"}', None) and out["q.json", 0] == ("ok", None)


def test_exported_texts_are_those_of_sparks_writer(spark, tmp_path):
    from docweave.sources.tables import export_texts
    methods = spark.createDataFrame(
        [("1", "a\nb"), ("1", "a\nb"), ("2", None), (None, "none"), ("", "empty"), ("a/b%:=c é", "odd"), ("3", "")],
        "method_id string, content string").coalesce(1)
    ours, other = str(tmp_path / "ours"), str(tmp_path / "sparks")
    export_texts(methods, ours)
    methods.selectExpr("method_id", "content value").write.partitionBy("method_id").text(other)

    def read(path):
        return sorted(map(str, spark.read.text(path).collect())), sorted(
            bytes(r.content) for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect())
    assert read(ours) == read(other)
    assert {p.parent.name for p in (tmp_path / "ours").rglob("part-*.txt")} == {
        p.parent.name for p in (tmp_path / "sparks").rglob("part-*.txt")}
    # Written by the tasks in place: no checksum file, which only Spark's writer leaves.
    assert not list((tmp_path / "ours").rglob(".part-*")) and (tmp_path / "ours" / "_SUCCESS").exists()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        export_texts(methods, ours)


@pytest.fixture
def many(monkeypatch):
    """Small folders are handled as those of many files; batches, walks and tasks are small."""
    from docweave.sources import folders
    for name, value in {"MAX_SCANNED_ENTRIES": 0, "FOLDERS_PER_WALK": 2, "MAX_TASK_FILE_BYTES": 40, "FILES_PER_TASK": 2,
                        "BATCH_ROWS": 3, "BATCH_BYTES": 30}.items():
        monkeypatch.setattr(folders, name, value)
    return monkeypatch


def odd_store(root):
    names = ["a.txt", "b c%20+d.txt", "e[1]{x}.txt", "é.md", "_hidden.txt", ".dot.txt", "_k=1.txt", "x._COPYING_", "big.csv",
             "big.txt", "empty.txt", "_metadata"]
    for folder in ("", "in/", "in/deep/er/", "_gone/", "_k=2/", "_metadata_x/", ".h/", "in/sp ce/", "y._COPYING_/"):
        for n, name in enumerate(names):
            put(root, folder + name, "" if name.startswith("empty") else f"{folder}{n}" + "x\n" * (40 if "big" in name else n))
    (root / "in/nothing").mkdir()
    (root / "in/lost").symlink_to(root / "nowhere")
    (root / "in/linked.txt").symlink_to(root / "a.txt")
    return str(root)


@pytest.mark.parametrize("glob", [None, "{*.txt,big*}", "[!b]*.txt", "*.csv"])
def test_tasks_list_and_read_a_folder_as_sparks_scan_does(spark, tmp_path, many, glob):
    from docweave.sources import folders
    root = odd_store(tmp_path)
    many.setattr(source, "MAX_FILE_BYTES", 90)
    many.setattr(source, "CSV_ROW_BYTES", 60)
    read = lambda: (rows(source.inventory(spark, root, glob)),
                    rows(source.read_bytes(spark, "file://" + root, glob)), rows(source.read_bytes(spark, [root], glob, csv_apart=True)))
    ours, scanned = read(), plan(source.inventory(spark, root, glob))
    many.setattr(folders, "MAX_SCANNED_ENTRIES", 10_000)
    assert ours == read() and len(ours[0]) == len(ours[1]) > 5
    # The driver lists nothing.
    assert "binaryFile" not in scanned and "binaryFile" in plan(source.inventory(spark, root, glob))
    # What is no plain folder is left to Spark's scan.
    many.setattr(folders, "MAX_SCANNED_ENTRIES", 0)
    assert folders.large_folder(spark, root + "/in/*") is folders.large_folder(spark, root + "/a.txt") is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        source.inventory(spark, root + "/no")


@pytest.mark.parametrize("listed", [0, 8])
def test_tasks_open_the_files_of_a_long_list(spark, tmp_path, many, listed):
    """By folder and from the root, also what no scan lists."""
    from docweave.sources import folders
    root = odd_store(tmp_path / "store")
    put(tmp_path, "beside.txt", "outside")
    many.setattr(source, "MAX_LISTED_PATHS", listed)
    many.setattr(source, "CSV_ROW_BYTES", 60)
    wanted = [str(p.relative_to(root)) for p in (tmp_path / "store").rglob("*") if listed == 0 or p.parent.name in ("er", "store", "")]
    wanted += ["/a.txt", "a.txt", None, "in//linked.txt", "./a.txt", "in/../a.txt", "../beside.txt", "none/a.txt", "a.txt/", ""]
    asked = spark.createDataFrame([(p, str(n)) for n, p in enumerate(wanted)], "full_path string, path string")
    read = lambda apart: source.attach_bytes(asked, root, csv_apart=apart)
    for apart in (False, True):
        ours = read(apart)
        with many.context() as scanned:
            scanned.setattr(folders, "is_shared", lambda *_: False)
            theirs = read(apart)
            assert ours.columns == theirs.columns and rows(ours) == rows(theirs) and ours.count() == len(wanted)
    many.setattr(folders, "MAX_TASK_FILE_BYTES", 1000)
    assert rows(read(True)) == rows(ours) and "binaryFile" not in plan(read(True)) and "binaryFile" in plan(theirs)
    body = {r.full_path: r.body for r in ours.collect()}
    assert body["a.txt"] == b"0" and body["big.csv"] is None and body["_hidden.txt"] is None


def test_exported_texts_are_read_by_tasks_as_by_sparks_reader(spark, tmp_path, many):
    from docweave.sources import folders
    methods = spark.createDataFrame(
        [("1", "a\nb"), ("1", "a\nb"), ("2", None), (None, "none\n\n"), ("", "\r\n x"), ("a/b%:=c é+", "odd"), ("03", ""),
         ("4", "\ufeffmark"), ("5", "long\n" * 30), ("6 [x]", "y" * 100)], "method_id string, content string").repartition(3)
    path = str(tmp_path / "texts")
    tables.export_texts(methods, path)
    ours = tables.exported_texts(spark, path)
    many.setattr(folders, "MAX_SCANNED_ENTRIES", 10_000)
    theirs = tables.exported_texts(spark, path)
    assert rows(ours) == rows(theirs) and ours.dtypes == theirs.dtypes and ours.count() == 4 + 1 + 3 + 2 + 1 + 1 + 1 + 31 + 1
    assert {r[0] for r in ours.distinct().collect()} == {"1", "2", None, "a/b%:=c é+", "03", "4", "5", "6 [x]"}
    many.setattr(folders, "MAX_SCANNED_ENTRIES", 0)
    many.setattr(folders, "MAX_TASK_FILE_BYTES", 1000)
    whole = tables.exported_texts(spark, path)
    assert rows(whole) == rows(theirs) and "FileScan text" not in plan(whole) and "FileScan text" in plan(theirs)
