"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Comparison: row count, column names, and an order-insensitive hash of the
values (columns sorted by name, values normalised to text).
"""

from __future__ import annotations

import hashlib
import sys
import time

import duckdb
import pandas as pd

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v) -> str:
    if v is None or (isinstance(v, float) and pd.isna(v)) or v is pd.NaT:
        return "NULL"
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def frame_hash(pdf: pd.DataFrame) -> str:
    cols = sorted(pdf.columns)
    rows = sorted("\x1f".join(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, dict]:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or qs:
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        rows = [r.asDict() for r in sdf.collect()]
        spdf = pd.DataFrame(rows, columns=sdf.columns)
        t1 = time.time()
        res = {"spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
        if name in sqls:
            cur = con.execute(sqls[name])
            opdf = pd.DataFrame(cur.fetchall(), columns=[d[0] for d in cur.description])
            res["oracle_rows"] = len(opdf)
            res["cols_match"] = sorted(spdf.columns) == sorted(opdf.columns)
            res["match"] = res["cols_match"] and len(spdf) == len(opdf) and frame_hash(spdf) == frame_hash(opdf)
            if not res["cols_match"]:
                res["cols"] = (sorted(spdf.columns), sorted(opdf.columns))
        out[name] = res
        if verbose:
            print(name, res, flush=True)
    return out


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from gatewatch.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = local_session(8)
    r = compare(spark, sf, names)
    bad = [k for k, v in r.items() if v.get("match") is False]
    print("MISMATCH:", bad)
