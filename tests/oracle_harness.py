"""Run registered queries against their DuckDB oracle and compare results.

Usage: python -m tests.oracle_harness [sf_dir] [key ...]

Comparison = row count, column names, and an order-insensitive hash of the
values (columns sorted by name, rows sorted), like the round driver does.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return repr(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, sf_dir: str, keys: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as entry

    qs, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for key in keys or list(qs):
        t0 = time.time()
        rec: dict = {}
        try:
            df = qs[key](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
            rec.update(rows=len(rows), spark_s=round(time.time() - t0, 2))
            if key in oracles:
                res = con.execute(oracles[key])
                ocols = [d[0] for d in res.description]
                orows = res.fetchall()
                rec.update(
                    oracle_rows=len(orows),
                    cols_match=sorted(cols) == sorted(ocols),
                    rows_match=len(rows) == len(orows),
                    hash_match=digest(cols, rows) == digest(ocols, orows),
                )
                if not rec["cols_match"]:
                    rec["cols"], rec["ocols"] = sorted(cols), sorted(ocols)
            else:
                rec["oracle"] = "none (rows only)"
        except Exception as exc:  # noqa: BLE001 - report and continue
            rec["error"] = f"{type(exc).__name__}: {str(exc)[:400]}"
        report[key] = rec
        if verbose:
            print(key, rec, flush=True)
    return report


def main() -> None:
    from tripmart.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session(master="local[8]", shuffle_partitions=8)
    report = compare(spark, sf_dir, keys)
    bad = [k for k, r in report.items() if "error" in r or r.get("hash_match") is False or r.get("cols_match") is False]
    print("FAILED:", bad if bad else "none")


if __name__ == "__main__":
    main()
