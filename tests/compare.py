"""Local stand-in for the driver's correctness check: run each query in Spark
and its oracle SQL in DuckDB, compare row count, column names and an
order-insensitive hash of the values."""

from __future__ import annotations

import datetime
import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def frame_hash(pdf: pd.DataFrame) -> str:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(str(norm(r[c])) for c in cols) for r in pdf.to_dict("records"))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(sf_dir: str, names: list[str]):
    import __spark_entry__ as E
    from tidewatch.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8, extra_conf={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            found = qs[name](spark, sf_dir)  # as Python objects: pandas turns integers with nulls into floats
            sp = pd.DataFrame([tuple(r) for r in found.collect()], columns=found.columns, dtype=object)
        except Exception as exc:  # noqa: BLE001
            print(f"{name:34s} SPARK ERROR {str(exc)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"{name:34s} rows={len(sp):7d} (no oracle) {t1-t0:.1f}s")
            continue
        try:
            answer = con.sql(sqls[name])
            dk = pd.DataFrame(answer.fetchall(), columns=answer.columns, dtype=object)
        except Exception as exc:  # noqa: BLE001
            print(f"{name:34s} ORACLE ERROR {str(exc)[:300]}")
            bad += 1
            continue
        same_cols = sorted(sp.columns) == sorted(dk.columns)
        ok = same_cols and len(sp) == len(dk) and frame_hash(sp) == frame_hash(dk)
        bad += not ok
        msg = "OK " if ok else "BAD"
        extra = "" if same_cols else f" cols spark-only={sorted(set(sp.columns)-set(dk.columns))} duck-only={sorted(set(dk.columns)-set(sp.columns))}"
        print(f"{name:34s} {msg} rows spark={len(sp)} duck={len(dk)} {t1-t0:.1f}s{extra}")
        if not ok and same_cols and len(sp) == len(dk):
            cols = sorted(sp.columns)
            a = sorted(tuple(str(norm(r[c])) for c in cols) for r in sp.to_dict("records"))
            b = sorted(tuple(str(norm(r[c])) for c in cols) for r in dk.to_dict("records"))
            for x, y in zip(a, b):
                if x != y:
                    diff = [(c, u, v) for c, u, v in zip(cols, x, y) if u != v]
                    print("    first diff:", diff[:6])
                    break
    print("mismatches:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
