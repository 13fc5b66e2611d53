"""Run a query in Spark and its SQL in DuckDB on the same files and compare the rows."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0) if isinstance(value, float) else repr(value)
    return f"{type(value).__name__}:{value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, sf_dir, query, sql):
    got = query(spark, sf_dir)
    mine = _rows(got.columns, [tuple(r) for r in got.collect()])
    if sql is None:
        return f"ok (rows only) {len(mine)} rows"
    relation = connect(sf_dir).sql(sql)
    theirs = _rows(relation.columns, relation.fetchall())
    if sorted(got.columns) != sorted(relation.columns):
        return f"COLUMNS {sorted(got.columns)} != {sorted(relation.columns)}"
    if mine == theirs:
        return f"ok {len(mine)} rows"
    only_mine, only_theirs = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
    return (f"DIFF rows {len(mine)} vs {len(theirs)}; only Spark {len(only_mine)} {str(only_mine[:3])[:600]}; "
            f"only SQL {len(only_theirs)} {str(only_theirs[:3])[:600]}")
