"""Inputs of the operators, derived from the supplied tables (see FIXTURES.md)."""

from pyspark.sql import functions as F

from docweave.functions.names import log_time
from docweave.session import spread_if_few
from docweave.sources.files import content_type

# Extensions in turn by source number, as the SQL side uses them.
EXTENSIONS = ("csv", "txt", "md", "json", "pdf", "docx", "TXT", "zip")
EPOCH_2024 = 1704067200


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark, sf_dir, name, key="doc_id"):
    """A table in enough tasks for work on its texts: the supplied files have one
    row group each."""
    return spread_if_few(table(spark, sf_dir, name), key)


def _minutes(start, ids):
    return F.timestamp_seconds(F.lit(start) + ids * 60)


def files(spark, sf_dir, source=table):
    """File metadata records, with `text` of the document."""
    number = F.substring("source", 4, 10).cast("int")
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]), number % len(EXTENSIONS) + 1)
    docs = source(spark, sf_dir, "documents").withColumn("_ext", ext)
    filename = F.concat_ws(".", F.col("doc_id").cast("string"), "_ext")
    when = log_time(_minutes(EPOCH_2024, F.col("doc_id")))
    return docs.select(
        F.col("doc_id").cast("string").alias("file_id"), F.col("lang").alias("parent_id"),
        filename.alias("filename"),
        F.concat(F.lit("/"), F.concat_ws("/", "lang", "source", filename)).alias("full_path"),
        F.concat_ws(".", "source", "lang").alias("category"), F.col("n_chars").alias("size_bytes"),
        when.alias("created_at"), when.alias("modified_at"), F.col("source").alias("created_by"),
        F.lit("document").alias("content_type"), F.col("_ext").alias("extension"),
        content_type(F.lower("_ext")).alias("mime_type"), F.lit("1.0").alias("metadata_version"),
        "text")


def metadata_only(frame):
    return frame.drop("text", "body")


def raw_files(spark, sf_dir):
    """File records as texts, with errors planted by source, language and length."""
    rows = metadata_only(files(spark, sf_dir))
    source = F.col("created_by")
    size = F.when(F.col("size_bytes") < 100, -F.col("size_bytes")).otherwise(F.col("size_bytes"))
    return rows.select(
        F.when(source == "src5", F.concat("parent_id", F.lit("-shared"))).otherwise(F.col("file_id"))
        .alias("file_id"),
        "parent_id", "filename",
        F.when(source == "src7", F.replace("full_path", F.lit("/"), F.lit("\\")))
        .otherwise(F.col("full_path")).alias("full_path"),
        F.when(F.col("parent_id") == "es", "").otherwise(F.col("category")).alias("category"),
        size.cast("string").alias("size_bytes"),
        F.when(source == "src3", "2024/01/01 10:00").otherwise(F.col("created_at")).alias("created_at"),
        "modified_at", "created_by", "content_type", "extension", "mime_type",
        F.when(source != "src2", F.col("metadata_version")).alias("metadata_version"))


def file_bodies(spark, sf_dir):
    """Files with `body`: CSV and JSON kinds wrap the text, other kinds are the text.

    The files of one source have a JSON extension but no JSON inside.
    """
    rows = files(spark, sf_dir, spread_table)
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    as_csv = F.concat(F.lit("file_id,text\n"), "file_id", F.lit(","), quoted)
    as_json = F.to_json(F.struct("file_id", "text"))
    body = (F.when(F.col("extension") == "csv", as_csv)
            .when((F.col("extension") == "json") & (F.col("created_by") != "src19"), as_json)
            .otherwise(F.col("text")))
    return rows.withColumn("body", body.cast("binary")).drop("text")


def methods(spark, sf_dir):
    number = F.substring("source", 4, 10).cast("int")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("method_id"), F.col("source").alias("method_name"),
        F.col("lang").alias("segment"), F.concat_ws(".", "source", "lang").alias("category"),
        F.col("source").alias("created_by"),
        F.when(number % 3 != 0, F.col("lang")).alias("updated_by"), F.col("text").alias("content"))


def method_state(spark, sf_dir):
    """Methods that are in the table before the run: those with a label."""
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    rows = table(spark, sf_dir, "documents").join(labelled, "doc_id", "left_semi")
    doc = F.col("doc_id").cast("string")
    return rows.select(
        doc.alias("method_id"), F.md5(F.concat(F.lit("old"), doc)).alias("uuid"),
        F.lit("before").alias("method_name"), F.col("lang").alias("segment"),
        F.col("source").alias("category"), F.lit("earlier text").alias("description"),
        F.lit("loader").alias("created_by"), F.lit(None).cast("string").alias("updated_by"),
        _minutes(EPOCH_2024 - 31 * 86400, F.col("doc_id")).alias("vector_created_at"),
        F.lit(None).cast("timestamp").alias("vector_updated_at"))


def vec(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), "embedding",
        F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("content"),
        F.create_map(F.lit("parity"), (F.col("vec_id") % 2).cast("string"),
                     F.lit("label"), F.col("label").cast("string")).alias("metadata"),
        F.concat(F.lit("ns"), F.col("label").cast("string")).alias("namespace"))


def centroids(vectors):
    """One mean vector per namespace: namespace, embedding (6 decimals)."""
    parts = vectors.select("namespace", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("namespace", "pos").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))
    # One value per dimension: groups are as long as a vector, whatever the data.
    ordered = F.array_sort(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy("namespace").agg(F.transform(ordered, lambda v: v["mean"]).alias("embedding"))


def mean_vector(vectors):
    """The mean of all vectors as a list: the fixed query vector of the searches."""
    whole = centroids(vectors.select(F.lit("all").alias("namespace"), "embedding"))
    return whole.first()["embedding"]


def messages(spark, sf_dir):
    """One message per event; by event type: plain, with blanks, with a bad id, or
    asking for ids that do not exist."""
    user = F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    value = (F.when(kind == "error", F.concat(user, F.lit(", "), k, F.lit(",x")))
             .when(kind == "signup", (F.col("event_id") + 1_000_000_000).cast("string"))
             .when(kind == "view", F.concat(F.lit(" "), user, F.lit(" ,\t"), k))
             .otherwise(F.concat_ws(",", user, k, F.col("event_id").cast("string"))))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("message_id"), value.alias("value"))


def run_log(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("chat_id"),
        F.timestamp_seconds(F.lit(EPOCH_2024) + F.floor(F.col("turn") / 2)).alias("ts"),
        F.col("turn").alias("seq"), F.col("text").alias("message"))


def batch_specs(spark, sf_dir):
    """JSON texts, one form per source number: valid, or with one rule broken."""
    path = F.concat(F.lit('"/'), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit('"'))
    meta = F.concat(F.lit('{"metadata": {"lang": "'), F.col("lang"), F.lit('"}}'))
    name = F.concat(F.lit('"collection_name": "'), F.col("lang"), F.lit('"'))

    def spec(paths):
        return F.concat(F.lit('{"file_path": '), paths, F.lit(", "), name, F.lit("}"))

    element = F.concat(F.lit("{"), path, F.lit(": "), meta, F.lit("}"))
    forms = [
        spec(F.concat(F.lit("["), element, F.lit(", "), element, F.lit("]"))),
        F.concat(F.lit("{"), name, F.lit("}")),
        spec(path),
        spec(F.concat(F.lit("[{"), path, F.lit(": "), meta, F.lit(', "second": '), meta, F.lit("}]"))),
        spec(F.concat(F.lit("["), element, F.lit(", {"), path, F.lit(': {"title": 1}}]'))),
        spec(F.concat(F.lit("[{"), path, F.lit(': {"metadata": 5}}]'))),
        spec(F.concat(F.lit("[{"), path, F.lit(": 7}]"))),
        F.concat(F.lit('{"file_path": ['), element, F.lit(']}')),
        F.concat(F.lit("["), element, F.lit("]")),
    ]
    number = F.substring("source", 4, 10).cast("int") % len(forms)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("entry_idx"), F.element_at(F.array(*forms), number + 1).alias("spec"))


def toxic_ids(spark, sf_dir):
    return table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))


def poor_ids(spark, sf_dir):
    return table(spark, sf_dir, "labels").where("quality = 0").select(F.col("doc_id").cast("string").alias("id"))


def vector_changes(spark, sf_dir):
    """Toxic ids come again with the opposite vector, which is added under a new id too."""
    old = vec(spark, sf_dir).join(toxic_ids(spark, sf_dir), "id", "left_semi")
    flipped = old.withColumn("embedding", F.transform("embedding", lambda x: -x))
    added = flipped.withColumn("id", F.concat(F.lit("new"), "id"))
    return flipped.unionByName(added)
