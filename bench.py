"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from docweave.session import build_session  # noqa: E402

HEADLINE = (
    "namespace_search", "topk_single", "knn_join", "chunk_stats", "hash_embedding", "file_etl",
    "method_upsert", "vector_upsert", "mutation_chain", "metadata_violations", "messages_without_match",
    "batches_per_category",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    with tempfile.TemporaryDirectory(prefix="bench-stage-") as shared:
        run(sf_dir, cpus, shared)


def run(sf_dir, cpus, shared):
    spark = build_session(
        "bench", f"local[{cpus}]", spark__checkpoint__dir=shared, spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    # Starts the JVM pools and one Python worker per core.
    QUERIES["hash_embedding"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall-clock", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
