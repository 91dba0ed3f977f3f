"""Compare registered queries with their SQL: python tools/check.py [--sf DIR] [--rows N] [names or modules]."""

import argparse
import importlib
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from tidemark import catalog  # noqa: E402
from tidemark.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def connect(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def compare(spark, con, name, sf, got=None):
    """None when equal, else what differs."""
    got = catalog.QUERIES[name](spark, sf) if got is None else got
    mine = rows_of(got.columns, [tuple(r) for r in got.collect()])
    if not mine[1]:
        return "no rows"
    if name not in catalog.SQL:
        return None
    cur = con.execute(catalog.SQL[name])
    names, types = [d[0] for d in cur.description], [str(d[1]) for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    if mine[1] != theirs[1]:
        left, right = set(mine[1]), set(theirs[1])
        a, b = sorted(left - right)[:3], sorted(right - left)[:3]
        return f"rows {len(mine[1])} vs {len(theirs[1])}; columns {mine[0]}; only Spark {a}; only SQL {b}"
    spark_types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    plain = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
             "TIMESTAMP": "timestamp_ntz", "DATE": "date"}
    odd = [(n, t, spark_types[n]) for n, t in zip(names, types) if plain.get(t) != spark_types[n]]
    return f"types {odd}" if odd else None


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--rows", help="rows per task, to force sliced plans")
    parser.add_argument("--module", action="append", default=[])
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    if args.module:
        for m in args.module:
            importlib.import_module(f"tidemark.queries.{m}")
    else:
        catalog.load()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    if args.rows:
        spark.conf.set("spark.tidemark.rowsPerTask", args.rows)
    con = connect(args.sf)
    bad = 0
    for name in args.names or catalog.QUERIES:
        start = time.time()
        try:
            wrong = compare(spark, con, name, args.sf)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += wrong is not None
        mark = "ok  " if wrong is None else "FAIL"
        kind = "" if name in catalog.SQL else " (no SQL)"
        print(f"{mark} {name}{kind} {time.time() - start:.2f}s {wrong or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
