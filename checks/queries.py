"""One query per operator: (spark, sf_dir) -> DataFrame. Maps and arrays are
flattened, and times shown as text, so that the rows compare between engines."""

import uuid
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks import tables as t
from docweave.functions import names
from docweave.functions.maps import fill_nulls, merge, record_map
from docweave.functions.vectors import COSINE, DOT, L2, similarity
from docweave.operators import batching, chunking, embedding, mutations, quality, reports, search, selection
from docweave.plans import file_etl as etl
from docweave.plans import method_sync as sync
from docweave.schemas import FILE_METADATA, conform_files
from docweave.session import stage, staging_root
from docweave.sources import files as file_source
from docweave.sources import messages as message_source
from docweave.sources import tables as table_source
from docweave.streaming import jobs

# Fixed values shared with the SQL side.
DIM = 64
QUERY_TEXT = "the erbleou station and the house on the hill"
RUN_TIME = "2024-02-01 12:00:00"
BATCH = 7


def long(column):
    return column.cast("bigint")


# Sources ---------------------------------------------------------------------

def file_inventory(spark, sf):
    return t.files(spark, sf).select(
        F.col("full_path").alias("name"), F.col("size_bytes").alias("size"),
        F.lit(None).cast("string").alias("creation_time"), F.col("modified_at").alias("last_modified"),
        file_source.content_type(names.extension("filename")).alias("content_type"))


def csv_row_documents(spark, sf):
    return file_source.row_documents(t.table(spark, sf, "customer")).select("c_custkey", "content")


def json_documents(spark, sf):
    content = file_source.compact_json(F.col("props"))
    return t.table(spark, sf, "events").select(
        "event_id", content.alias("content"), F.get_json_object(content, "$.k").alias("k"))


def format_dispatch(spark, sf):
    return file_source.file_documents(t.file_bodies(spark, sf)).select(
        "file_id", long(F.col("doc_no")).alias("doc_no"), long(F.length("content")).alias("chars"),
        F.md5("content").alias("content_md5"), "error")


def parameterised_lookup(spark, sf):
    t.table(spark, sf, "orders").createOrReplaceTempView("orders_lookup")
    return table_source.query(
        spark, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders_lookup "
        "WHERE o_orderstatus = :status AND o_totalprice >= :floor", status="F", floor=250000.0)


def message_ids(spark, sf):
    return quality.message_ids(t.messages(spark, sf)).select("message_id", long(F.col("position")).alias("position"), "id")


def method_records(spark, sf):
    return table_source.method_records(t.methods(spark, sf)).select(
        "metadata.*", F.md5("content").alias("content_md5"))


# Relational mutations --------------------------------------------------------

def delete_files(spark, sf):
    catalogue = t.files(spark, sf).select(
        F.col("parent_id").alias("container"), F.col("filename").alias("name"), "size_bytes", "file_id")
    gone = catalogue.join(t.toxic_ids(spark, sf).withColumnRenamed("id", "file_id"), "file_id", "left_semi")
    return mutations.delete_files(catalogue, gone).drop("file_id")


def run_log_latest(spark, sf):
    return reports.run_log_latest(t.run_log(spark, sf))


def _orders(spark, sf):
    return t.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _opening_orders(spark, sf):
    """A balancing order for each customer in debt."""
    return t.table(spark, sf, "customer").where("c_acctbal < 0").select(
        (-F.col("c_custkey") - 1).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"),
        F.lit("N").alias("o_orderstatus"), (-F.col("c_acctbal")).alias("o_totalprice"),
        F.lit(None).cast("string").alias("o_orderpriority"))


def _returned_orders(spark, sf):
    """New status and a cleared priority for orders with returned items."""
    returned = t.table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    return returned.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.concat(F.lit("R"), F.count(F.lit(1)).cast("string")).alias("o_orderstatus"),
        F.lit(None).cast("string").alias("o_orderpriority"))


def _large_orders(spark, sf):
    return t.table(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_orderkey").alias("o_orderkey"))


def insert_records(spark, sf):
    return mutations.insert(_orders(spark, sf), _opening_orders(spark, sf))


def update_records(spark, sf):
    return mutations.update(_orders(spark, sf), _returned_orders(spark, sf), ["o_orderkey"])


def delete_records(spark, sf):
    return mutations.delete(_orders(spark, sf), _large_orders(spark, sf), ["o_orderkey"])


def mutation_chain(spark, sf):
    return mutations.chain(
        _orders(spark, sf),
        lambda cur: mutations.delete(cur, _large_orders(spark, sf), ["o_orderkey"]),
        lambda cur: mutations.update(cur, _returned_orders(spark, sf), ["o_orderkey"]),
        lambda cur: mutations.insert(cur, _opening_orders(spark, sf)))


# Projections and checks ------------------------------------------------------

def typed_metadata(spark, sf):
    typed = conform_files(t.raw_files(spark, sf))
    return typed.select(*[names.table_time(F.col(n)).alias(n) if n.endswith("_at") else F.col(n)
                          for n in FILE_METADATA.names])


def metadata_violations(spark, sf):
    checked = quality.rule_violations(t.raw_files(spark, sf))
    return checked.select("filename", "file_id", F.explode("violations").alias("rule"))


def files_by_id(spark, sf):
    ids = quality.message_ids(t.messages(spark, sf)).select(F.col("id").alias("file_id"))
    return selection.by_ids(t.metadata_only(t.files(spark, sf)), ids, "file_id").select("file_id", "full_path")


def methods_by_id(spark, sf):
    asked, _ = sync.requested_records(
        t.messages(spark, sf), table_source.method_records(t.methods(spark, sf)))
    return asked.select("method_id", "method_name", F.md5("content").alias("content_md5"))


def message_validation(spark, sf):
    return quality.check_messages(t.messages(spark, sf)).select(
        "message_id", "valid", F.concat_ws("|", "bad_ids").alias("bad_ids"))


def messages_without_match(spark, sf):
    valid = quality.check_messages(t.messages(spark, sf)).where("valid")
    return quality.unmatched_messages(valid, t.methods(spark, sf), "method_id").select("message_id", "value")


def batch_spec_violations(spark, sf):
    return quality.batch_spec_violations(t.batch_specs(spark, sf)).select(
        "entry_idx", long(F.col("path_idx")).alias("path_idx"), "rule")


def metadata_map(spark, sf):
    rows = t.methods(spark, sf)
    filled = fill_nulls(record_map("method_name", "segment", "category", "created_by", "updated_by"))
    return rows.select("method_id", F.explode(filled).alias("key", "value"))


def metadata_merge(spark, sf):
    left = record_map("method_name", "segment", "updated_by")
    right = F.create_map(F.lit("segment"), F.upper("segment"), F.lit("uuid"), F.md5("method_id"))
    return t.methods(spark, sf).select("method_id", F.explode(merge(left, right)).alias("key", "value"))


def path_functions(spark, sf):
    return t.files(spark, sf).select(
        "file_id", names.extension("filename").alias("extension"),
        names.base_name("full_path").alias("base_name"),
        names.extension(F.replace("filename", F.lit("."), F.lit("_"))).alias("no_dot"))


def name_cleanup(spark, sf):
    return t.files(spark, sf).select(
        "file_id", names.collection_of(F.col("category")).alias("collection"),
        names.namespace_of(F.col("category")).alias("namespace"))


def time_formats(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return t.table(spark, sf, "events").select(
        "event_id", names.table_time(ts).alias("table_time"), names.log_time(ts).alias("log_time"),
        names.log_key(F.col("event_id").cast("string"), ts).alias("log_key"))


# Reports ---------------------------------------------------------------------

def category_batches(spark, sf):
    return reports.category_batches(t.files(spark, sf))


def namespace_stats(spark, sf):
    return reports.namespace_stats(t.vec(spark, sf)).withColumn("dimensions", long(F.col("dimensions")))


def collection_count(spark, sf):
    return reports.collection_count(t.vec(spark, sf))


def _outcomes(spark, sf):
    return file_source.file_documents(t.file_bodies(spark, sf)).select("file_id", "category", "error")


def failure_report(spark, sf):
    return reports.failure_counts(_outcomes(spark, sf))


def failure_messages(spark, sf):
    return reports.failure_messages(_outcomes(spark, sf))


def list_collections(spark, sf):
    entries = t.files(spark, sf).select(
        names.collection_of(F.col("category")).alias("name"), "created_at",
        F.initcap("content_type").alias("type"))
    return reports.list_collections(entries)


def get_or_create_collections(spark, sf):
    """Collections that are there before: those of labelled documents."""
    all_files = t.files(spark, sf).select("file_id", names.collection_of(F.col("category")).alias("name"), "created_at")
    labelled = t.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("file_id"))
    there = reports.list_collections(all_files.join(labelled, "file_id", "left_semi")
                                     .select("name", "created_at", F.lit("Image").alias("type")))
    return mutations.get_or_create_collections(there, all_files.select("name"), F.lit(RUN_TIME))


def batches_per_category(spark, sf):
    rows = t.files(spark, sf).select("category", "file_id")
    return batching.fixed_batches(rows, 10, ["file_id"], within=["category"])


def batches_global(spark, sf):
    rows = t.files(spark, sf).select("file_id", "full_path")
    return batching.fixed_batches(rows, 64, ["file_id"])


# Text ------------------------------------------------------------------------

def _chunks(spark, sf):
    docs = t.files(spark, sf, t.spread_table).select("file_id", "full_path", F.col("text").alias("content"))
    return chunking.chunk_documents(docs)


def chunk_stats(spark, sf):
    return _chunks(spark, sf).groupBy("file_id").agg(
        F.count(F.lit(1)).alias("chunks"), long(F.max(F.length("chunk"))).alias("longest"),
        long(F.sum(F.length("chunk"))).alias("chars"))


def chunk_conservation(spark, sf):
    solid = F.length(F.regexp_replace("chunk", r"\s", ""))
    return _chunks(spark, sf).groupBy("file_id").agg(
        long(F.sum(solid)).alias("solid_chars"), (F.max(F.length("chunk")) <= 1000).alias("fits"))


def chunk_ids(spark, sf):
    return _chunks(spark, sf).select(
        chunking.chunk_id(F.col("full_path"), F.col("chunk_no")).alias("id"),
        long(F.col("chunk_no")).alias("chunk_no"), F.md5("chunk").alias("chunk_md5"))


def hash_embedding(spark, sf):
    docs = t.spread_table(spark, sf, "documents").select("doc_id", "text")
    rows = embedding.embed_rows(docs, "text", dim=DIM)
    return (rows.select("doc_id", F.posexplode("embedding").alias("bucket", "weight")).where("weight <> 0")
            .select("doc_id", long(F.col("bucket")).alias("bucket"),
                    F.round(F.col("weight").cast("double"), 5).alias("weight")))


# Search ----------------------------------------------------------------------

def _ranked(found):
    return found.select("id", "namespace", F.round("score", 6).alias("score"), long(F.col("rank")).alias("rank"))


def namespace_search(spark, sf):
    vectors = t.vec(spark, sf)
    return _ranked(search.search(vectors, t.mean_vector(vectors), 5, namespace="ns3"))


def filtered_search(spark, sf):
    vectors = t.vec(spark, sf)
    return _ranked(search.search(vectors, t.mean_vector(vectors), search.COLLECTION_K, metric=L2,
                                 namespace=search.ALL_NAMESPACES, filters={"parity": "1"}))


def topk_single(spark, sf):
    docs = t.spread_table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"),
        F.create_map(F.lit("lang"), F.col("lang")).alias("metadata"), F.col("lang").alias("namespace"))
    vectors = embedding.embed_rows(docs, "content", dim=DIM)
    return _ranked(search.search_text(vectors, QUERY_TEXT, 5, dim=DIM, namespace=search.ALL_NAMESPACES))


def knn_join(spark, sf):
    vectors = t.vec(spark, sf)
    queries = t.centroids(vectors).select(F.col("namespace").alias("query_id"), "embedding")
    return search.knn_join(vectors, queries, 5).select(
        "query_id", "id", F.round("score", 6).alias("score"), long(F.col("rank")).alias("rank"))


def _metric(metric, spark, sf):
    """Every vector against the centroid of its namespace."""
    vectors = t.vec(spark, sf)
    middle = t.centroids(vectors).withColumnRenamed("embedding", "middle")
    score = similarity(metric, F.col("embedding"), F.col("middle"))
    return vectors.join(middle, "namespace").select("id", F.round(score, 6).alias("score"))


# Vector mutations ------------------------------------------------------------

def _shown(vectors):
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return vectors.select("namespace", "id", "content", F.round(total, 5).alias("total"))


def vector_upsert(spark, sf):
    return _shown(mutations.upsert_vectors(t.vec(spark, sf), t.vector_changes(spark, sf)))


def vector_delete(spark, sf):
    vectors = t.vec(spark, sf)
    gone = vectors.join(t.poor_ids(spark, sf), "id", "left_semi").select("namespace", "id")
    return _shown(mutations.delete_vectors(vectors, gone))


def vector_update(spark, sf):
    changes = t.vector_changes(spark, sf).select(
        "namespace", "id", "embedding",
        F.create_map(F.lit("parity"), F.lit("changed"), F.lit("by"), F.lit("update")).alias("metadata"))
    after = mutations.update_vectors(t.vec(spark, sf), changes)
    shown = _shown(after.withColumn("content", F.concat_ws(
        "|", *[F.col("metadata")[k] for k in ("label", "parity", "by")])))
    return shown


def namespace_delete(spark, sf):
    return _shown(mutations.delete_namespace(t.vec(spark, sf), "ns3"))


def collection_delete(spark, sf):
    vectors = t.vec(spark, sf)
    collections = vectors.select(F.col("namespace").alias("name")).distinct().withColumns(
        {"created_at": F.lit(None).cast("timestamp"), "type": F.lit("Document")})
    left, names_left = mutations.delete_collection(vectors, collections, "ns4")
    return reports.collection_count(left).join(
        names_left.select(F.col("name").alias("collection")), "collection", "full_outer")


# Whole jobs ------------------------------------------------------------------

def _planned(spark, sf):
    asked, _ = sync.requested_records(
        t.messages(spark, sf), table_source.method_records(t.methods(spark, sf)))
    return stage(sync.classify(asked, t.method_state(spark, sf)), "planned-methods")


def _next_rows(spark, sf):
    return sync.next_metadata(_planned(spark, sf), F.to_timestamp(F.lit(RUN_TIME)), BATCH)


def sync_classify(spark, sf):
    return _planned(spark, sf).select("method_id", "exists", "old_uuid")


def method_upsert(spark, sf):
    after = mutations.upsert(t.method_state(spark, sf), _next_rows(spark, sf), ["method_id"], unique=True)
    return after.select(
        "method_id", "uuid", "method_name", "segment", "category", F.md5("description").alias("description_md5"),
        "created_by", "updated_by", names.table_time(F.col("vector_created_at")).alias("vector_created_at"),
        names.table_time(F.col("vector_updated_at")).alias("vector_updated_at"))


def sync_old_ids(spark, sf):
    return sync.old_vector_ids(_planned(spark, sf))


def sync_documents(spark, sf):
    docs = _next_rows(spark, sf).select(F.col("uuid").alias("id"), sync.document_metadata().alias("metadata"))
    return docs.select("id", F.explode("metadata").alias("key", "value"))


def method_sync(spark, sf):
    """Both tables' worth of changes, embedded; rejected messages are counted."""
    done = sync.sync_methods(
        t.messages(spark, sf), table_source.method_records(t.methods(spark, sf)), t.method_state(spark, sf),
        F.to_timestamp(F.lit(RUN_TIME)), BATCH, dim=DIM)
    parts = [("metadata", done.metadata), ("old_vectors", done.old_vectors), ("vectors", done.vectors)]
    counts = [df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n")) for name, df in parts]
    counts.append(done.rejects.groupBy(F.substring_index("reason", ":", 1).alias("part"))
                  .agg(F.count(F.lit(1)).alias("n")))
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def _etl(spark, sf):
    return etl.process_files(t.file_bodies(spark, sf), dim=DIM)


def file_etl(spark, sf):
    done = _etl(spark, sf)
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return done.vectors.select(
        "id", "namespace", F.md5("content").alias("content_md5"), F.col("metadata")["file_id"].alias("file_id"),
        F.round(length, 3).alias("length"))


def file_etl_outcomes(spark, sf):
    return _etl(spark, sf).outcomes


def outcome_counts(spark, sf):
    """Counts observed while the outcomes were written."""
    counts = _etl(spark, sf).counts
    return spark.createDataFrame(list(counts.items()), "outcome string, files bigint")


# User functions, files and streams ---------------------------------------------

def _place(spark, name):
    """A new folder beside the staged tables."""
    return f"{staging_root(spark)}/docweave/{name}-{uuid.uuid4().hex}"


def line_splitter(spark, sf):
    """Chunks by a splitter of the user: the lines of a text."""
    docs = t.files(spark, sf, t.spread_table).select("file_id", F.col("text").alias("content"))
    chunks = chunking.chunk_documents(docs, splitter=lambda text: [x for x in text.split("\n") if x])
    return chunks.select("file_id", long(F.col("chunk_no")).alias("chunk_no"), F.md5("chunk").alias("chunk_md5"))


def _letter_model():
    return lambda texts: [[float(text.count("a")), float(text.count("e"))] for text in texts]


def letter_embedding(spark, sf):
    """Vectors of a model of the user: numbers of two letters."""
    docs = t.spread_table(spark, sf, "documents").select("doc_id", "text")
    made = embedding.embed_rows(docs, "text", _letter_model, 2)
    return made.select("doc_id", F.col("embedding")[0].cast("double").alias("a"),
                       F.col("embedding")[1].cast("double").alias("e"))


def extracted_documents(spark, sf):
    """Documents by extractors of the user: a text per file, or one per line."""
    found = file_source.file_documents(t.file_bodies(spark, sf), {
        "pdf": lambda body: [body.decode()], "docx": lambda body: body.decode().split("\n")})
    return found.select("file_id", long(F.col("doc_no")).alias("doc_no"), F.md5("content").alias("content_md5"), "error")


def table_overwrite(spark, sf):
    """Vectors written, written over by their opposites, and read back."""
    path = _place(spark, "overwrite")
    vectors = t.vec(spark, sf)
    table_source.write_table(vectors, path, partition_by=["namespace"])
    flipped = vectors.withColumn("embedding", F.transform("embedding", lambda x: -x))
    table_source.write_table(flipped, path, overwrite=True, partition_by=["namespace"])
    return _shown(spark.read.schema(vectors.schema).parquet(path))


def _exported(spark, sf):
    path = _place(spark, "texts")
    table_source.export_texts(t.methods(spark, sf), path)
    return path


def text_export(spark, sf):
    """The exported texts, read back line by line."""
    lines = table_source.exported_texts(spark, _exported(spark, sf))
    return lines.groupBy("method_id").agg(
        F.count(F.lit(1)).alias("lines"), long(F.sum(F.length("value"))).alias("chars"))


def stored_files(spark, sf):
    """Inventory and contents of files in a store."""
    path = _exported(spark, sf)
    method = F.regexp_extract("name", "method_id=([0-9]+)", 1).alias("method_id")
    listed = file_source.inventory(spark, path, "*.txt").select(method, "size", "name", "content_type")
    bodies = file_source.read_bytes(spark, path, "*.txt").select(
        F.col("path").alias("name"), F.md5("content").alias("content_md5"))
    return listed.join(bodies, "name").select("method_id", long(F.col("size")).alias("size"), "content_type", "content_md5")


def dimension_guard(spark, sf):
    """Vectors of toxic documents are cut short, and found."""
    toxic = t.toxic_ids(spark, sf).withColumn("short", F.lit(True))
    mixed = t.vec(spark, sf).join(toxic, "id", "left").withColumn(
        "embedding", F.when(F.col("short"), F.slice("embedding", 1, 3)).otherwise(F.col("embedding")))
    return mutations.wrong_dimension(mixed.drop("short"), 64).select("id", "namespace")


def everything_deleted(spark, sf):
    vectors = t.vec(spark, sf)
    left = mutations.delete_all_namespaces(vectors).groupBy("namespace").agg(F.count(F.lit(1)).alias("after"))
    before = vectors.groupBy("namespace").agg(F.count(F.lit(1)).alias("before"))
    return before.join(left, "namespace", "left").select("namespace", "before", F.coalesce("after", F.lit(0)).cast("bigint").alias("after"))


def knn_self(spark, sf):
    """Every vector against all vectors."""
    vectors = t.vec(spark, sf)
    found = search.knn_join(vectors, vectors.select(F.col("id").alias("query_id"), "embedding"), 5)
    return found.select("query_id", "id", F.round("score", 6).alias("score"), long(F.col("rank")).alias("rank"))


def method_stream(spark, sf):
    """Messages read as a stream, one per source with the ids of its methods, and once
    more for some: the second message finds its methods in the table."""
    queue, tables, mark = (_place(spark, n) for n in ("queue", "methods", "mark"))
    methods = t.methods(spark, sf)
    asked = methods.groupBy(F.col("method_name").alias("message")).agg(
        F.array_join(F.collect_list("method_id"), ",").alias("value"))
    log = jobs.method_tables(spark, tables)
    records = table_source.method_records(methods)
    for turn in (asked, asked.where("message in ('src1', 'src2')")):
        turn.write.mode("append").partitionBy("message").text(queue)
        stream = message_source.message_stream(spark, f"{queue}/*")
        jobs.start_method_job(stream, log, records, mark, True, run_time=F.to_timestamp(F.lit(RUN_TIME)),
                              dim=DIM).awaitTermination()
    return _published_methods(log)


def _published_methods(log):
    current = log.current("methods", derived={"description": F.md5("description")}).select(
        "method_id", "uuid", F.col("description").alias("description_md5"),
        F.col("vector_updated_at").isNotNull().alias("updated"))
    return current.join(log.current("vectors").select(F.col("id").alias("uuid"), F.lit(True).alias("stored")), "uuid", "left")


def replayed_batch(spark, sf):
    """A batch that fails after its first table is written, is run again, and is run
    once more when it is already published: its changes count once."""
    methods, log = t.methods(spark, sf), jobs.method_tables(spark, _place(spark, "replayed"))
    records, run = table_source.method_records(methods), {"run_time": F.to_timestamp(F.lit(RUN_TIME)), "dim": DIM}
    asked = methods.groupBy(F.col("method_name").alias("message_id")).agg(
        F.array_join(F.collect_list("method_id"), ",").alias("value"))
    jobs.apply_method_messages(asked, 0, log, records, **run)
    lost = log.current("methods").withColumn("description", F.lit("lost"))
    torn = log.current("vectors").withColumn("id", F.raise_error(F.lit("lost executor")).cast("string"))
    try:
        log.publish(1, {"methods": (lost, None), "vectors": (torn, None)})
    except PySparkException as failure:
        if "lost executor" not in str(failure):
            raise
    for _ in range(2):
        jobs.apply_method_messages(asked.where("message_id in ('src1', 'src2')"), 1, log, records, **run)
    return _published_methods(log)


def file_stream(spark, sf):
    """Files of a store, asked for by messages; their chunks are published."""
    store, queue, tables, mark = (_place(spark, n) for n in ("store", "queue", "files", "mark"))
    docs = t.files(spark, sf)
    table_source.export_texts(docs.select(F.col("file_id").alias("method_id"), F.col("text").alias("content")), store)
    # The writer names the files: take their paths from the inventory.
    placed = stage(file_source.inventory(spark, store, "*.txt").select(
        F.regexp_extract("name", "method_id=([0-9]+)", 1).alias("file_id"),
        F.regexp_extract("name", "(/method_id=[0-9]+/.*)$", 1).alias("full_path")), "placed")
    catalogue = t.metadata_only(docs).drop("full_path").join(placed, "file_id").withColumn("extension", F.lit("txt"))
    asked = docs.groupBy(F.col("created_by").alias("message")).agg(
        F.array_join(F.collect_list("file_id"), ", ").alias("value"))
    asked.write.partitionBy("message").text(queue)
    log = jobs.file_tables(spark, tables)
    jobs.start_file_job(message_source.message_stream(spark, f"{queue}/*"), log, stage(catalogue, "catalogue"), store, mark,
                        True, dim=DIM).awaitTermination()
    chunks = log.current("vectors").groupBy(F.col("metadata")["file_id"].alias("file_id")).agg(
        F.count(F.lit(1)).alias("chunks"), long(F.sum(F.length("content"))).alias("chars"))
    return log.current("outcomes").select("file_id", "stage").join(chunks, "file_id", "left")


QUERIES = {f.__name__: f for f in (
    line_splitter, letter_embedding, extracted_documents, table_overwrite, text_export, stored_files,
    dimension_guard, everything_deleted, knn_self, method_stream, replayed_batch, file_stream,
    namespace_search, file_inventory, csv_row_documents, json_documents, format_dispatch,
    parameterised_lookup, message_ids, method_records, delete_files, run_log_latest, insert_records,
    update_records, delete_records, mutation_chain, typed_metadata, metadata_violations, files_by_id,
    methods_by_id, message_validation, messages_without_match, batch_spec_violations, metadata_map,
    metadata_merge, path_functions, name_cleanup, time_formats, category_batches, namespace_stats,
    collection_count, failure_report, failure_messages, list_collections, get_or_create_collections,
    batches_per_category, batches_global, chunk_stats, chunk_conservation, chunk_ids, hash_embedding,
    filtered_search, topk_single, knn_join, vector_upsert, vector_delete, vector_update,
    namespace_delete, collection_delete, sync_classify, method_upsert, sync_old_ids, sync_documents,
    method_sync, file_etl, file_etl_outcomes, outcome_counts)}
QUERIES["metric_dot"] = partial(_metric, DOT)
QUERIES["metric_cosine"] = partial(_metric, COSINE)
QUERIES["metric_l2"] = partial(_metric, L2)
