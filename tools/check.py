"""Run registered queries and compare them with their SQL on DuckDB.

usage: python tools/check.py [--sf 0.01] [--plan] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from frameline.fixtures import Tables  # noqa: E402
from frameline.registry import load  # noqa: E402
from frameline.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False):
        cells = []
        for v in row:
            if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and not isinstance(v, (str, bytes)) and getattr(v, "shape", ()) != ():
                cells.append(repr(list(v)))
            elif v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
                cells.append("\\N")
            elif isinstance(v, bool) or type(v).__name__ == "bool_":
                cells.append(str(bool(v)))
            elif hasattr(v, "isoformat"):
                cells.append(pd.Timestamp(v).isoformat())
            elif isinstance(v, (int, float)) or hasattr(v, "dtype"):
                cells.append(repr(round(float(v), 9)))
            elif type(v).__name__ == "Decimal":
                cells.append(repr(round(float(v), 9)))
            else:
                cells.append(str(v))
        rows.append(tuple(cells))
    return sorted(rows)


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("names", nargs="*")
    args.add_argument("--sf", default="0.01")
    args.add_argument("--plan", action="store_true")
    opts = args.parse_args()
    folder = f"/root/testdata/sf{opts.sf}"
    spark = build_session("check", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    catalog = load()
    names = opts.names or list(catalog)
    bad = []
    for name in names:
        q = catalog[name]
        start = time.time()
        try:
            df = q.run(Tables(spark, folder))
            if opts.plan:
                df.explain("formatted")
            ours = df.toPandas()
            took = time.time() - start
            if q.sql is None:
                print(f"rows  {name:34s} {len(ours):8d} rows {took:6.2f}s", flush=True)
                continue
            result = con.execute(q.sql)
            types = [(d[0], str(d[1])) for d in result.description]
            theirs = result.fetchdf()
            a, b = canonical(ours), canonical(theirs)
            if sorted(ours.columns) != sorted(theirs.columns):
                bad.append(name)
                print(f"COLS  {name}: {sorted(ours.columns)} vs {sorted(theirs.columns)}")
            elif a != b:
                bad.append(name)
                sa, sb = set(a), set(b)
                extra, missing = [r for r in a if r not in sb][:3], [r for r in b if r not in sa][:3]
                print(f"DIFF  {name}: {len(a)} vs {len(b)} rows\n  cols {sorted(ours.columns)}\n  only ours {extra}\n  only sql  {missing}")
            else:
                spark_types = dict(df.dtypes)
                odd = [(c, spark_types[c], t) for c, t in types if not same_type(spark_types[c], t)]
                print(f"ok    {name:34s} {len(a):8d} rows {took:6.2f}s {'TYPES ' + str(odd) if odd else ''}{' EMPTY' if not a else ''}", flush=True)
        except Exception as error:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL  {name}: {type(error).__name__} {str(error)[:1200]}", flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} good; bad: {bad}")
    spark.stop()
    return 1 if bad else 0


def same_type(ours: str, theirs: str) -> bool:
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    return pairs.get(ours, ours).upper() == theirs.upper() or ours.startswith("array")


if __name__ == "__main__":
    raise SystemExit(main())
