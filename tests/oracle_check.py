"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison mirrors the driver's gate: same column names, same row count,
compatible types, and the same multiset of rows (order-insensitive).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TYPE_MAP = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP WITH TIME ZONE": "timestamp",
    "BOOLEAN": "boolean",
    "FLOAT": "float",
}


def _norm(v):
    if isinstance(v, float):
        return ("f", v)
    if isinstance(v, decimal.Decimal):
        return ("f", float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if v is None:
        return ("n", "")
    return (type(v).__name__[0], v)


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    spark_cols = df.columns
    spark_types = [f.dataType.simpleString() for f in df.schema.fields]
    elapsed = time.time() - t0
    out = {"name": name, "spark_rows": len(spark_rows), "spark_sec": round(elapsed, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    cur = con.execute(sql)
    duck_cols = [d[0] for d in cur.description]
    duck_types = [str(d[1]) for d in cur.description]
    duck_rows = cur.fetchall()
    out["duck_rows"] = len(duck_rows)
    problems = []
    if sorted(spark_cols) != sorted(duck_cols):
        problems.append(f"columns spark={spark_cols} duck={duck_cols}")
    else:
        for c, t in zip(spark_cols, spark_types):
            dtype = duck_types[duck_cols.index(c)]
            if TYPE_MAP.get(dtype, dtype) != t and not (t == "timestamp" and dtype.startswith("TIMESTAMP")):
                problems.append(f"type {c}: spark={t} duck={dtype}")
        order = sorted(range(len(spark_cols)), key=lambda i: spark_cols[i])
        dorder = [duck_cols.index(spark_cols[i]) for i in order]
        a = sorted(tuple(_norm(r[i]) for i in order) for r in spark_rows)
        b = sorted(tuple(_norm(r[i]) for i in dorder) for r in duck_rows)
        if len(a) != len(b):
            problems.append(f"rowcount spark={len(a)} duck={len(b)}")
        if a != b:
            sa, sb = set(a), set(b)
            only_a = [x for x in a if x not in sb][:3]
            only_b = [x for x in b if x not in sa][:3]
            problems.append(f"values differ; spark-only={only_a} duck-only={only_b}")
    out["status"] = "ok" if not problems else "MISMATCH"
    if problems:
        out["problems"] = problems
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from jobmart.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            res = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as exc:  # report and continue
            res = {"name": name, "status": "ERROR", "error": str(exc)[:800]}
        bad += res["status"] not in ("ok", "rows-only")
        print(res, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
