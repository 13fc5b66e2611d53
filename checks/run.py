"""Compare the queries with their SQL: python -m checks.run [sf_dir] [names...]"""

import sys
import tempfile
import time

from checks.compare import compare
from checks.queries import QUERIES
from checks.sql import ORACLE
from docweave.session import build_session


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:] or list(QUERIES)
    with tempfile.TemporaryDirectory(prefix="checks-stage-") as shared:
        run(sf_dir, chosen, shared)


def run(sf_dir, chosen, shared):
    spark = build_session("checks", "local[8]", spark__checkpoint__dir=shared, spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in chosen:
        began = time.time()
        try:
            verdict = compare(spark, sf_dir, QUERIES[name], ORACLE.get(name))
        except Exception as failure:  # noqa: BLE001 - reported below
            verdict = f"ERROR {type(failure).__name__}: {str(failure)[:1500]}"
        bad += not verdict.startswith("ok")
        print(f"{name:28s} {time.time() - began:6.2f}s {verdict}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
