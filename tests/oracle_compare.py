"""Run every catalogue query in Spark and its oracle SQL in DuckDB, and compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Prints one line per key: rows, column names, column types and an order-insensitive, exact
comparison of the values.
"""

from __future__ import annotations

import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


_SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN"}


def _raw(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v.item() if hasattr(v, "item") else v


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS {s_cols} vs {d_cols}"
        return res
    spark_types = {f.name: _SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    duck_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    if spark_types != duck_types:
        res["status"] = f"TYPES {spark_types} vs {duck_types}"
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = [d_cols.index(s_cols[i]) for i in order]
    # Values and column types must be identical as returned (no re-rounding); NaN compares equal.
    a = sorted((tuple(_raw(r[i]) for i in order) for r in s_rows), key=repr)
    b = sorted((tuple(_raw(r[i]) for i in d_index) for r in d_rows), key=repr)
    res["status"] = "MATCH" if a == b else "VALUES DIFFER"
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        res["sample_spark_only"] = diff
        res["sample_oracle_only"] = [x for x in b if x not in set(a)][:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as entry
    from dispersa.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs = entry.queries()
    sqls = entry.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            r = compare(spark, con, key, qs[key], sqls.get(key), sf_dir)
        except Exception as e:  # report and continue
            r = {"key": key, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("MATCH", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys or qs) - bad} ok, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
