"""Compare every registered query with its DuckDB oracle (what the driver does).

    python tests/oracle_check.py [sf_dir] [name ...]

Prints one line per query: rows on each side, column match, and the number
of rows that differ after an order-insensitive comparison (floats compared
exactly and, separately, at 1e-9 relative tolerance).
"""

from __future__ import annotations

import math
import sys
import tempfile
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, tol: bool):
    if v is None:
        return None
    if hasattr(v, "isoformat") and not isinstance(v, str):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) if tol else v
    if hasattr(v, "as_tuple"):  # Decimal
        return float(v)
    return v


def _rows(rows, cols, tol):
    return sorted((tuple(_norm(r[c], tol) for c in cols) for r in rows), key=repr)


def compare(spark, con, name, builder, sql, sf_dir):
    t0 = time.time()
    sdf = builder(spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    scols = sorted(sdf.columns)
    if sql is None:
        return f"{name:32s} spark={len(srows):7d} (no oracle) {t1 - t0:.1f}s"
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    colok = sorted(dcols) == scols
    if not colok:
        return (f"{name:32s} COLUMNS DIFFER spark-only={sorted(set(scols) - set(dcols))} "
                f"duck-only={sorted(set(dcols) - set(scols))}")
    exact = _rows(srows, scols, False) == _rows(drows, scols, False)
    a, b = _rows(srows, scols, True), _rows(drows, scols, True)
    ndiff = len(set(a) ^ set(b))
    status = "OK" if exact else ("OK~" if a == b else "DIFF")
    return f"{name:32s} {status:4s} spark={len(srows):7d} duck={len(drows):7d} diffrows={ndiff} {t1 - t0:.1f}s"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from stormcab.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")})
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    for name, b in qs.items():
        if only and name not in only:
            continue
        try:
            print(compare(spark, con, name, b, os_.get(name), sf_dir), flush=True)
        except Exception as exc:  # report and continue
            print(f"{name:32s} ERROR {type(exc).__name__}: {str(exc)[:300]}", flush=True)


if __name__ == "__main__":
    main()
