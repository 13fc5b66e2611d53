"""DuckDB SQL of each query, on the same tables."""

from checks.queries import BATCH, DIM, QUERY_TEXT, RUN_TIME

# Fixed value: the blanks Python's strip() removes, and the ASCII ones among them.
BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
          "        　")
ASCII_BLANKS = "\t\n\x0b\x0c\r "

# Each view, and the views it needs.
VIEWS = {
    "files": """
        SELECT *, CAST(doc_id AS VARCHAR) AS file_id, lang AS parent_id, doc_id || '.' || extension AS filename,
               '/' || lang || '/' || source || '/' || doc_id || '.' || extension AS full_path,
               source || '.' || lang AS category, n_chars AS size_bytes,
               strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id), '%Y-%m-%dT%H:%M:%SZ') AS created_at,
               source AS created_by, 'document' AS content_type,
               CASE lower(extension)
                 WHEN 'csv' THEN 'text/csv' WHEN 'txt' THEN 'text/plain' WHEN 'md' THEN 'text/markdown'
                 WHEN 'json' THEN 'application/json' WHEN 'pdf' THEN 'application/pdf'
                 WHEN 'docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
                 ELSE 'application/octet-stream' END AS mime_type
        FROM (SELECT *, ['csv', 'txt', 'md', 'json', 'pdf', 'docx', 'TXT', 'zip']
                        [CAST(substr(source, 4) AS INT) % 8 + 1] AS extension FROM documents)""",
    "raw_files": """
        SELECT CASE WHEN source = 'src5' THEN lang || '-shared' ELSE file_id END AS file_id, parent_id, filename,
               CASE WHEN source = 'src7' THEN replace(full_path, '/', '\\') ELSE full_path END AS full_path,
               CASE WHEN lang = 'es' THEN '' ELSE category END AS category,
               CASE WHEN n_chars < 100 THEN -n_chars ELSE n_chars END AS size_bytes,
               CASE WHEN source = 'src3' THEN '2024/01/01 10:00' ELSE created_at END AS created_at,
               created_at AS modified_at, created_by, content_type, extension, mime_type
        FROM files""",
    "file_docs": f"""
        SELECT file_id, category, full_path,
               CASE WHEN extension = 'csv' THEN
                      'file_id: ' || file_id || chr(10) || 'text: ' || trim(text, '{BLANKS}')
                    WHEN extension = 'json' AND source <> 'src19' THEN
                      CAST(json_object('file_id', file_id, 'text', text) AS VARCHAR)
                    WHEN lower(extension) IN ('txt', 'md') THEN text END AS content,
               CASE WHEN extension = 'zip' THEN 'unsupported format: zip'
                    WHEN extension IN ('pdf', 'docx') THEN 'no extractor for ' || extension
                    WHEN extension = 'json' AND source = 'src19' THEN 'not valid JSON' END AS error
        FROM files""",
    "methods": """
        SELECT CAST(doc_id AS VARCHAR) AS method_id, source AS method_name, lang AS segment,
               source || '.' || lang AS category, source AS created_by,
               CASE WHEN CAST(substr(source, 4) AS INT) % 3 <> 0 THEN lang END AS updated_by, text AS content
        FROM documents""",
    "method_state": """
        SELECT CAST(doc_id AS VARCHAR) AS method_id, md5('old' || doc_id) AS uuid, 'before' AS method_name,
               lang AS segment, source AS category, 'earlier text' AS description, 'loader' AS created_by,
               CAST(NULL AS VARCHAR) AS updated_by,
               strftime(TIMESTAMP '2023-12-01' + to_minutes(doc_id), '%Y-%m-%d %H:%M:%S') AS vector_created_at,
               CAST(NULL AS VARCHAR) AS vector_updated_at
        FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "vec": """
        SELECT CAST(vec_id AS VARCHAR) AS id, embedding, 'vector ' || vec_id AS content, 'ns' || label AS namespace,
               CAST(vec_id % 2 AS VARCHAR) AS parity, CAST(label AS VARCHAR) AS label
        FROM embeddings""",
    "vector_changes": """
        SELECT id, list_transform(embedding, lambda x: -x) AS embedding, content, namespace FROM vec
        WHERE id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)""",
    "centroids": """
        SELECT namespace, list(mean ORDER BY pos) AS middle
        FROM (SELECT namespace, pos, round(avg(x), 6) AS mean
              FROM (SELECT namespace, generate_subscripts(embedding, 1) AS pos,
                           unnest(CAST(embedding AS DOUBLE[])) AS x FROM vec)
              GROUP BY namespace, pos)
        GROUP BY namespace""",
    "mean_vector": """
        SELECT list(mean ORDER BY pos) AS q
        FROM (SELECT pos, round(avg(x), 6) AS mean
              FROM (SELECT generate_subscripts(embedding, 1) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM vec)
              GROUP BY pos)""",
    "messages": """
        SELECT CAST(event_id AS VARCHAR) AS message_id,
               CASE event_type WHEN 'error' THEN user_id || ', ' || k || ',x'
                               WHEN 'signup' THEN CAST(event_id + 1000000000 AS VARCHAR)
                               WHEN 'view' THEN ' ' || user_id || ' ,' || chr(9) || k
                               ELSE user_id || ',' || k || ',' || event_id END AS value
        FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)""",
    "ids": f"""
        SELECT message_id, generate_subscripts(string_split(value, ','), 1) - 1 AS position,
               trim(unnest(string_split(value, ',')), '{ASCII_BLANKS}') AS id
        FROM messages""",
    "checked": """
        SELECT message_id, bool_and(regexp_full_match(id, '[0-9]+')) AS valid,
               coalesce(string_agg(id, '|' ORDER BY position) FILTER (NOT regexp_full_match(id, '[0-9]+')), '') AS bad_ids
        FROM ids GROUP BY message_id""",
    "asked": """
        SELECT * FROM methods WHERE method_id IN
          (SELECT id FROM ids JOIN checked USING (message_id) WHERE valid)""",
    "planned": """
        SELECT a.*, s.method_id IS NOT NULL AS exists_, s.uuid AS old_uuid, s.vector_created_at AS old_created_at
        FROM asked a LEFT JOIN method_state s USING (method_id)""",
    "next_rows": f"""
        SELECT method_id, {{uuid:method_id || '|{BATCH}'}} AS uuid, method_name, segment, category,
               content AS description, created_by, updated_by,
               CASE WHEN exists_ THEN old_created_at ELSE '{RUN_TIME}' END AS vector_created_at,
               CASE WHEN exists_ THEN '{RUN_TIME}' END AS vector_updated_at
        FROM planned""",
}
NEEDS = {
    "raw_files": ["files"], "file_docs": ["files"], "vector_changes": ["vec"], "centroids": ["vec"],
    "mean_vector": ["vec"], "ids": ["messages"], "checked": ["ids"], "asked": ["checked", "methods"],
    "planned": ["asked", "method_state"], "next_rows": ["planned"],
}


def uuid_of(text):
    digest = f"md5({text})"
    return " || '-' || ".join(f"substr({digest}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def with_views(body, *views, first=""):
    """`body` after the definitions of `views` and all they need."""
    order = []

    def add(view):
        for other in NEEDS.get(view, []):
            add(other)
        if view not in order:
            order.append(view)

    for view in views:
        add(view)
    parts = []
    for view in order:
        text = VIEWS[view]
        if view == "next_rows":
            text = text.replace(f"{{uuid:method_id || '|{BATCH}'}}", uuid_of(f"method_id || '|{BATCH}'"))
        parts.append(f"{view} AS ({text})")
    if first:
        parts.append(first)
    head = f"WITH RECURSIVE {', '.join(parts)} " if parts else ""
    return head + body


def chunk_views(source):
    """Recursive splitting of `source` (key, text) by line, blank and length; the
    supplied texts have no blank lines. One step moves each text one chunk on, or
    into a line (l2) or word (l3) that is itself too long."""
    def last(sep):
        window = "substr(text, s + 2, 1000)"
        return (f"CASE WHEN strpos({window}, {sep}) > 0 THEN s + length({window}) + 1 "
                f"- strpos(reverse({window}), {sep}) END")

    def upcoming(sep, end):
        rest = f"substr(text, s + 2, {end} - s - 1)"
        return f"CASE WHEN strpos({rest}, {sep}) > 0 THEN s + strpos({rest}, {sep}) ELSE {end} END"

    return f"""
        src AS (SELECT key, text, length(text) AS n FROM {source}),
        walk AS (
          SELECT key, CAST(0 AS BIGINT) AS s, CAST(NULL AS BIGINT) AS l2, CAST(NULL AS BIGINT) AS l3,
                 CAST(NULL AS BIGINT) AS lo, CAST(NULL AS BIGINT) AS hi
          FROM src
          UNION ALL
          SELECT key,
                 CAST(coalesce(cut, s) AS BIGINT),
                 CAST(CASE WHEN cut IS NOT NULL AND cut = l2 THEN NULL
                           WHEN l2 IS NULL AND cut IS NULL THEN {upcoming("chr(10)", "n")} ELSE l2 END AS BIGINT),
                 CAST(CASE WHEN cut IS NOT NULL AND cut = l3 THEN NULL
                           WHEN l2 IS NOT NULL AND l3 IS NULL AND cut IS NULL THEN {upcoming("' '", "l2")}
                           ELSE l3 END AS BIGINT),
                 CASE WHEN cut IS NOT NULL THEN s END,
                 CAST(cut AS BIGINT)
          FROM (SELECT key, text, n, s, l2, l3,
                       CASE WHEN l3 IS NOT NULL THEN least(s + 1000, l3)
                            WHEN l2 IS NOT NULL THEN CASE WHEN l2 - s <= 1000 THEN l2 ELSE {last("' '")} END
                            WHEN n - s <= 1000 THEN n ELSE {last("chr(10)")} END AS cut
                FROM walk JOIN src USING (key) WHERE s < n)
        ),
        pieces AS (
          SELECT key, lo, trim(substr(text, lo + 1, hi - lo), '{BLANKS}') AS chunk
          FROM walk JOIN src USING (key) WHERE lo IS NOT NULL),
        chunks AS (
          SELECT key, row_number() OVER (PARTITION BY key ORDER BY lo) - 1 AS chunk_no, chunk
          FROM pieces WHERE chunk <> '')"""


def buckets(text, key, source):
    """Hashed word counts of `text`, scaled to unit length, as single floats."""
    return f"""
        (SELECT {key}, bucket,
                CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY {key})) AS FLOAT) AS DOUBLE) AS weight
         FROM (SELECT {key}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {DIM} AS bucket,
                      CAST(count(*) AS DOUBLE) AS c
               FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+')) AS w FROM {source})
               GROUP BY ALL))"""


SHOWN = "namespace, id, content, round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total"
DOC_CHUNKS = chunk_views("(SELECT file_id AS key, text FROM files)")
RETURNED = """returned AS (SELECT l_orderkey AS o_orderkey, 'R' || count(*) AS status FROM lineitem
              WHERE l_returnflag = 'R' GROUP BY l_orderkey)"""
ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
OPENING = """SELECT -c_custkey - 1 AS o_orderkey, c_custkey AS o_custkey, 'N' AS o_orderstatus, -c_acctbal AS o_totalprice,
             CAST(NULL AS VARCHAR) AS o_orderpriority
             FROM customer WHERE c_acctbal < 0"""
UPDATED = """SELECT o_orderkey, o_custkey, coalesce(status, o_orderstatus) AS o_orderstatus, o_totalprice,
             CASE WHEN status IS NULL THEN o_orderpriority END AS o_orderpriority
             FROM orders LEFT JOIN returned USING (o_orderkey)"""
NOT_LARGE = "o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)"
METHOD_FIELDS = ("method_name", "segment", "category", "created_by", "updated_by", "method_id")


def pairs(fields, source, key):
    return " UNION ALL ".join(
        f"SELECT {key}, '{name}' AS key, coalesce({value}, '') AS value FROM {source}" for name, value in fields)


def top(k, rows, order="score DESC, id"):
    return f"""SELECT id, namespace, score, row_number() OVER (ORDER BY {order}) AS rank
               FROM ({rows}) ORDER BY {order} LIMIT {k}"""


def batches(size, columns, partition):
    rn = f"row_number() OVER ({partition} ORDER BY file_id) - 1"
    return f"SELECT {columns}, ({rn}) // {size} AS batch_no, ({rn}) % {size} AS position FROM files"


def metric(expression):
    return with_views(f"SELECT id, round({expression}, 6) AS score FROM vec JOIN centroids USING (namespace)", "centroids")


DOUBLES = "CAST(embedding AS DOUBLE[])"

ORACLE = {
    "file_inventory": with_views(
        """SELECT full_path AS name, size_bytes AS size, CAST(NULL AS VARCHAR) AS creation_time,
           created_at AS last_modified, mime_type AS content_type FROM files""", "files"),
    "csv_row_documents": """
        SELECT c_custkey, 'c_custkey: ' || c_custkey || chr(10) || 'c_name: ' || c_name || chr(10)
          || 'c_nationkey: ' || c_nationkey || chr(10) || 'c_acctbal: ' || c_acctbal || chr(10)
          || 'c_mktsegment: ' || c_mktsegment AS content FROM customer""",
    "json_documents": """
        SELECT event_id, CAST(json(props) AS VARCHAR) AS content, json_extract_string(props, '$.k') AS k FROM events""",
    "format_dispatch": with_views(
        """SELECT file_id, CAST(0 AS BIGINT) AS doc_no, length(content) AS chars, md5(content) AS content_md5, error
           FROM file_docs""", "file_docs"),
    "parameterised_lookup": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 250000.0""",
    "message_ids": with_views("SELECT message_id, position, id FROM ids", "ids"),
    "method_records": with_views(
        f"SELECT {', '.join(METHOD_FIELDS)}, md5(content) AS content_md5 FROM methods", "methods"),
    "delete_files": with_views(
        """SELECT parent_id AS container, filename AS name, size_bytes FROM files
           WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""", "files"),
    "run_log_latest": """
        SELECT conv_id || '/' || strftime(TIMESTAMP '2024-01-01' + to_seconds(turn // 2), '%Y-%m-%dT%H:%M:%SZ')
                 || '.txt' AS name, CAST(conv_id AS VARCHAR) AS chat_id, arg_max(text, turn) AS message
        FROM conversations GROUP BY conv_id, turn // 2""",
    "insert_records": f"SELECT {ORDERS} FROM orders UNION ALL {OPENING}",
    "update_records": f"WITH {RETURNED} {UPDATED}",
    "delete_records": f"SELECT {ORDERS} FROM orders WHERE {NOT_LARGE}",
    "mutation_chain": f"WITH {RETURNED} {UPDATED} WHERE {NOT_LARGE} UNION ALL {OPENING}",
    "typed_metadata": with_views(
        """SELECT file_id, parent_id, filename, full_path, category, size_bytes,
             strftime(try_strptime(created_at, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S') AS created_at,
             strftime(try_strptime(modified_at, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S') AS modified_at,
             created_by, content_type, extension, mime_type, '1.0' AS metadata_version FROM raw_files""", "raw_files"),
    "metadata_violations": with_views(
        """SELECT filename, file_id, 'category_empty' AS rule FROM raw_files WHERE category = ''
           UNION ALL SELECT filename, file_id, 'created_at_format' FROM raw_files WHERE created_at LIKE '%/%'
           UNION ALL SELECT filename, file_id, 'size_bytes_negative' FROM raw_files WHERE size_bytes < 0
           UNION ALL SELECT filename, file_id, 'full_path_separator' FROM raw_files WHERE contains(full_path, chr(92))
           UNION ALL SELECT filename, file_id, 'extension_form' FROM raw_files WHERE extension <> lower(extension)
           UNION ALL SELECT filename, file_id, 'file_id_duplicate' FROM raw_files WHERE file_id IN
             (SELECT file_id FROM raw_files GROUP BY file_id HAVING count(*) > 1)""", "raw_files"),
    "files_by_id": with_views(
        "SELECT file_id, full_path FROM files WHERE file_id IN (SELECT id FROM ids)", "files", "ids"),
    "methods_by_id": with_views("SELECT method_id, method_name, md5(content) AS content_md5 FROM asked", "asked"),
    "message_validation": with_views("SELECT message_id, valid, bad_ids FROM checked", "checked"),
    "messages_without_match": with_views(
        """SELECT message_id, value FROM messages JOIN checked USING (message_id) WHERE valid AND message_id NOT IN
           (SELECT message_id FROM ids WHERE id IN (SELECT method_id FROM methods))""", "checked", "methods"),
    "batch_spec_violations": """
        SELECT doc_id AS entry_idx, CAST(path_idx AS BIGINT) AS path_idx, rule
        FROM (SELECT doc_id, CAST(substr(source, 4) AS INT) % 9 AS form FROM documents)
        JOIN (VALUES (1, NULL, 'file_path missing'), (2, NULL, 'file_path is not a list'),
                     (3, 0, 'element must have exactly one path'), (4, 1, 'metadata missing'),
                     (5, 0, 'metadata is not an object'), (6, 0, 'value of the path is not an object'),
                     (7, NULL, 'collection_name missing'), (8, NULL, 'entry is not an object'))
             AS rules(form, path_idx, rule) USING (form)""",
    "metadata_map": with_views(
        pairs([(f, f) for f in METHOD_FIELDS if f != "method_id"], "methods", "method_id"), "methods"),
    "metadata_merge": with_views(
        """SELECT method_id, 'method_name' AS key, method_name AS value FROM methods
           UNION ALL SELECT method_id, 'updated_by', updated_by FROM methods
           UNION ALL SELECT method_id, 'segment', upper(segment) FROM methods
           UNION ALL SELECT method_id, 'uuid', md5(method_id) FROM methods""", "methods"),
    "path_functions": with_views(
        """SELECT file_id, lower(extension) AS extension, filename AS base_name,
           lower(replace(filename, '.', '_')) AS no_dot FROM files""", "files"),
    "name_cleanup": with_views(
        """SELECT file_id, replace(category, '.', '') AS collection, replace(category, '.', '_') AS namespace
           FROM files""", "files"),
    "time_formats": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS table_time, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS log_time,
               event_id || '/' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '.txt' AS log_key FROM events""",
    "category_batches": with_views(
        """SELECT category, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS total_bytes
           FROM files GROUP BY category""", "files"),
    "namespace_stats": with_views(
        """SELECT namespace AS namespaces, max(len(embedding)) AS dimensions, count(*) AS vector_count
           FROM vec GROUP BY namespace""", "vec"),
    "collection_count": with_views(
        "SELECT namespace AS collection, count(*) AS documents FROM vec GROUP BY namespace", "vec"),
    "failure_report": with_views(
        """SELECT category, count_if(error IS NULL)::BIGINT AS ok, count_if(error IS NOT NULL)::BIGINT AS failed
           FROM file_docs GROUP BY category""", "file_docs"),
    "failure_messages": with_views(
        "SELECT category, error, count(*) AS files FROM file_docs WHERE error IS NOT NULL GROUP BY ALL", "file_docs"),
    "list_collections": with_views(
        """SELECT replace(category, '.', '') AS name, min(created_at) AS created_at, 'Document' AS type
           FROM files GROUP BY ALL""", "files"),
    "get_or_create_collections": with_views(
        f"""SELECT name, coalesce(min(created_at) FILTER (labelled), '{RUN_TIME}') AS created_at,
                   CASE WHEN bool_or(labelled) THEN 'Image' ELSE 'Document' END AS type
            FROM (SELECT replace(category, '.', '') AS name, created_at,
                         doc_id IN (SELECT doc_id FROM labels) AS labelled FROM files)
            GROUP BY name""", "files"),
    "batches_per_category": with_views(batches(10, "category, file_id", "PARTITION BY category"), "files"),
    "batches_global": with_views(batches(64, "file_id, full_path", ""), "files"),
    "chunk_stats": with_views(
        """SELECT key AS file_id, count(*) AS chunks, max(length(chunk)) AS longest,
           CAST(sum(length(chunk)) AS BIGINT) AS chars FROM chunks GROUP BY key""", "files", first=DOC_CHUNKS),
    "chunk_conservation": """
        SELECT CAST(doc_id AS VARCHAR) AS file_id, length(regexp_replace(text, '\\s', '', 'g')) AS solid_chars,
               TRUE AS fits FROM documents""",
    "chunk_ids": with_views(
        f"""SELECT {uuid_of("full_path || '|' || chunk_no")} AS id, chunk_no, md5(chunk) AS chunk_md5
            FROM chunks JOIN files ON key = file_id""", "files", first=DOC_CHUNKS),
    "hash_embedding": f"SELECT doc_id, bucket, round(weight, 5) AS weight FROM {buckets('text', 'doc_id', 'documents')}",
    "namespace_search": with_views(
        top(5, f"""SELECT id, namespace, round(list_inner_product({DOUBLES}, q), 6) AS score
                   FROM vec, mean_vector WHERE namespace = 'ns3'"""), "mean_vector"),
    "filtered_search": with_views(
        top(3, f"""SELECT id, namespace, round(pow(list_distance({DOUBLES}, q), 2), 6) AS score
                   FROM vec, mean_vector WHERE parity = '1'""", "score, id"), "mean_vector"),
    "topk_single": top(5, f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, any_value(lang) AS namespace, round(sum(d.weight * q.weight), 6) AS score
        FROM {buckets('text', 'doc_id', 'documents')} d
        JOIN {buckets('text', 'one', f"(SELECT 1 AS one, '{QUERY_TEXT}' AS text)")} q USING (bucket)
        JOIN documents USING (doc_id) GROUP BY doc_id"""),
    "knn_join": with_views(
        f"""SELECT query_id, id, score, rank FROM (
              SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
              FROM (SELECT centroids.namespace AS query_id, id, round(list_inner_product({DOUBLES}, middle), 6) AS score
                    FROM vec, centroids)) WHERE rank <= 5""", "centroids"),
    "metric_dot": metric(f"list_inner_product({DOUBLES}, middle)"),
    "metric_cosine": metric(f"list_cosine_similarity({DOUBLES}, middle)"),
    "metric_l2": metric(f"pow(list_distance({DOUBLES}, middle), 2)"),
    "vector_upsert": with_views(
        f"""SELECT {SHOWN} FROM vec WHERE id NOT IN (SELECT id FROM vector_changes)
            UNION ALL SELECT {SHOWN} FROM vector_changes
            UNION ALL SELECT namespace, 'new' || id, content, round(list_sum({DOUBLES}), 5) FROM vector_changes""",
        "vector_changes"),
    "vector_delete": with_views(
        f"""SELECT {SHOWN} FROM vec WHERE id NOT IN
            (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 0)""", "vec"),
    "vector_update": with_views(
        f"""SELECT namespace, id,
              CASE WHEN hit THEN label || '|changed|update' ELSE label || '|' || parity END AS content,
              round(list_sum({DOUBLES}) * CASE WHEN hit THEN -1 ELSE 1 END, 5) AS total
            FROM (SELECT *, id IN (SELECT id FROM vector_changes) AS hit FROM vec)""", "vector_changes"),
    "namespace_delete": with_views(f"SELECT {SHOWN} FROM vec WHERE namespace <> 'ns3'", "vec"),
    "collection_delete": with_views(
        "SELECT namespace AS collection, count(*) AS documents FROM vec WHERE namespace <> 'ns4' GROUP BY namespace",
        "vec"),
    "sync_classify": with_views('SELECT method_id, exists_ AS "exists", old_uuid FROM planned', "planned"),
    "method_upsert": with_views(
        """SELECT method_id, uuid, method_name, segment, category, md5(description) AS description_md5, created_by,
                  updated_by, vector_created_at, vector_updated_at
           FROM (SELECT * FROM method_state WHERE method_id NOT IN (SELECT method_id FROM next_rows)
                 UNION ALL SELECT * FROM next_rows)""", "next_rows"),
    "sync_old_ids": with_views("SELECT 'default' AS namespace, old_uuid AS id FROM planned WHERE exists_", "planned"),
    "sync_documents": with_views(
        pairs([*[(f, f) for f in METHOD_FIELDS], ("uuid", "uuid"), ("vectorCreatedAt", "vector_created_at"),
               ("vectorUpdatedAt", "vector_updated_at")], "next_rows", "uuid AS id"), "next_rows"),
    "method_sync": with_views(
        """SELECT 'metadata' AS part, count(*) AS n FROM next_rows
           UNION ALL SELECT 'vectors', count(*) FROM next_rows
           UNION ALL SELECT 'old_vectors', count(*) FROM planned WHERE exists_
           UNION ALL SELECT 'ids are not numeric', count(*) FROM checked WHERE NOT valid
           UNION ALL SELECT 'no matching data', count(*) FROM checked WHERE valid AND message_id NOT IN
             (SELECT message_id FROM ids WHERE id IN (SELECT method_id FROM methods))""", "next_rows"),
    "file_etl": with_views(
        f"""SELECT {uuid_of("full_path || '|0|' || chunk_no")} AS id, replace(category, '.', '_') AS namespace,
                   md5(chunk) AS content_md5, file_id,
                   CASE WHEN regexp_matches(lower(chunk), '[a-z0-9]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS length
            FROM chunks JOIN file_docs ON key = file_id""", "file_docs",
        first=chunk_views("(SELECT file_id AS key, content AS text FROM file_docs WHERE error IS NULL)")),
    "file_etl_outcomes": with_views(
        """SELECT file_id, category, full_path, CAST(1 AS BIGINT) AS documents,
                  coalesce(n_chunks, 0) AS chunks,
                  CASE WHEN error IS NOT NULL THEN 'read' WHEN n_chunks IS NULL THEN 'split' END AS stage,
                  CASE WHEN error IS NOT NULL THEN error WHEN n_chunks IS NULL THEN 'no text in file' END AS error
           FROM file_docs LEFT JOIN (SELECT key, count(*) AS n_chunks FROM chunks GROUP BY key) ON key = file_id""",
        "file_docs",
        first=chunk_views("(SELECT file_id AS key, content AS text FROM file_docs WHERE error IS NULL)")),
    "line_splitter": """
        SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY pos) - 1 AS chunk_no, md5(line) AS chunk_md5
        FROM (SELECT CAST(doc_id AS VARCHAR) AS file_id, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) WHERE line <> ''""",
    "letter_embedding": """
        SELECT doc_id, CAST(length(text) - length(replace(text, 'a', '')) AS DOUBLE) AS a,
               CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS e FROM documents""",
    "extracted_documents": with_views(
        """SELECT file_id, 0::BIGINT AS doc_no, md5(content) AS content_md5, error FROM file_docs
             WHERE error IS NULL OR NOT starts_with(error, 'no extractor')
           UNION ALL SELECT file_id, 0, md5(text), NULL FROM files WHERE extension = 'pdf'
           UNION ALL SELECT file_id, pos - 1, md5(line), NULL FROM (
             SELECT file_id, unnest(string_split(text, chr(10))) AS line,
                    generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM files WHERE extension = 'docx')""",
        "file_docs"),
    "table_overwrite": with_views(
        f"SELECT namespace, id, content, round(-list_sum({DOUBLES}), 5) AS total FROM vec", "vec"),
    "text_export": """
        SELECT CAST(doc_id AS VARCHAR) AS method_id, len(string_split(text, chr(10))) AS lines,
               length(replace(text, chr(10), '')) AS chars FROM documents""",
    "stored_files": """
        SELECT CAST(doc_id AS VARCHAR) AS method_id, strlen(text) + 1 AS size, 'text/plain' AS content_type,
               md5(text || chr(10)) AS content_md5 FROM documents""",
    "dimension_guard": with_views(
        "SELECT id, namespace FROM vec WHERE id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)", "vec"),
    "everything_deleted": with_views(
        "SELECT namespace, count(*) AS before, 0::BIGINT AS after FROM vec GROUP BY namespace", "vec"),
    "knn_self": with_views(
        """SELECT query_id, id, score, rank FROM (
             SELECT query_id, id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
             FROM (SELECT a.id AS query_id, b.id, list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
                   FROM vec a, vec b)) WHERE rank <= 5""", "vec"),
    "method_stream": with_views(
        f"""SELECT method_id, {uuid_of("method_id || CASE WHEN again THEN '|1' ELSE '|0' END")} AS uuid,
                   md5(content) AS description_md5, again AS updated, true AS stored
            FROM (SELECT *, method_name IN ('src1', 'src2') AS again FROM methods)""", "methods"),
    "file_stream": with_views(
        """SELECT file_id, CASE WHEN n_chunks IS NULL THEN 'split' END AS stage, n_chunks AS chunks, n AS chars
           FROM files LEFT JOIN (SELECT key, count(*) AS n_chunks, CAST(sum(length(chunk)) AS BIGINT) AS n
                                 FROM chunks GROUP BY key) ON key = file_id""", "files",
        first=DOC_CHUNKS),
}
ORACLE["replayed_batch"] = ORACLE["method_stream"]
ORACLE["outcome_counts"] = f"""
    SELECT outcome, files FROM (
        UNPIVOT (SELECT count(*) FILTER (error IS NULL) AS ok, count(*) FILTER (error IS NOT NULL) AS failed,
                        count(*) FILTER (stage = 'read') AS failed_read, count(*) FILTER (stage = 'split') AS failed_split,
                        count(*) FILTER (stage = 'embed') AS failed_embed
                 FROM ({ORACLE["file_etl_outcomes"]})) ON COLUMNS(*) INTO NAME outcome VALUE files)"""
