"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Mirrors the driver's correctness gate: row count, column names, and an
order-insensitive comparison of values. Values are compared exactly
(decimals as decimals, floats bit for bit) so that a pass here is a pass
under any reasonable hashing.

    python -m mercato.plans.oracle_check [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, decimal.Decimal):
        return ("num", str(v.normalize()) if v != 0 else "0")
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", str(decimal.Decimal(v)))
    if isinstance(v, float):
        return ("float", repr(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("list", tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return ("map", tuple(sorted((k, _norm(x)) for k, x in v.items())))
    if isinstance(v, (bytes, bytearray)):
        return ("bytes", bytes(v).hex())
    return ("str", str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def duckdb_connection(sf_dir: str):
    import duckdb

    from mercato.sources.tables import TABLES

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, sf_dir: str, names=None, verbose=True):
    from mercato.plans.registry import all_queries

    queries = all_queries()
    con = duckdb_connection(sf_dir)
    results = {}
    for name, q in queries.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = q.fn(spark, sf_dir)
            spark_cols = df.columns
            spark_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:32s} SPARK_ERROR {results[name][1]}", flush=True)
            continue
        t_spark = time.time() - t0
        if q.oracle is None:
            results[name] = ("ROWS_ONLY", len(spark_rows))
            if verbose:
                print(f"{name:32s} rows-only n={len(spark_rows)} {t_spark:.2f}s", flush=True)
            continue
        try:
            rel = con.sql(q.oracle)
            duck_cols = list(rel.columns)
            duck_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("ORACLE_ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:32s} ORACLE_ERROR {results[name][1]}", flush=True)
            continue
        sc, sr = _rows(spark_cols, spark_rows)
        dc, dr = _rows(duck_cols, duck_rows)
        if sc != dc:
            status = ("COLS", f"spark={sc} duck={dc}")
        elif len(sr) != len(dr):
            status = ("COUNT", f"spark={len(sr)} duck={len(dr)}")
        elif sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
            status = ("VALUES", f"first diffs: {diff}")
        else:
            status = ("OK", len(sr))
        results[name] = status
        if verbose:
            print(f"{name:32s} {status[0]} {str(status[1])[:400]} {t_spark:.2f}s", flush=True)
    return results


def main(argv):
    from mercato.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = set(argv[2:]) or None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = check(spark, sf_dir, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; failing: {sorted(bad)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
