"""Run ``queries()`` in Spark and ``oracle_sql()`` in DuckDB and compare.

Row count, column names and an order-insensitive hash of the values.
Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.6g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


_SPARK_TO_SQL = {
    "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "float": "FLOAT", "double": "DOUBLE",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def type_mismatches(df, rel) -> list[str]:
    """Columns whose Spark type does not correspond to the oracle's DuckDB type."""
    spark_types = {f.name: _SPARK_TO_SQL.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    return [f"{c}: {spark_types[c]} vs {duck_types.get(c)}" for c in spark_types if spark_types[c] != duck_types.get(c)]


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, keys=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
            t_spark = time.time() - t0
        except Exception as e:  # noqa: BLE001
            results[k] = ("SPARK_ERROR", repr(e)[:400])
            if verbose:
                print(f"{k:32s} SPARK_ERROR {repr(e)[:400]}", flush=True)
            continue
        if k not in sqls:
            results[k] = ("NO_ORACLE", len(rows))
            if verbose:
                print(f"{k:32s} NO_ORACLE rows={len(rows)} {t_spark:.1f}s", flush=True)
            continue
        try:
            rel = con.sql(sqls[k])
            ocols = rel.columns
            orows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[k] = ("ORACLE_ERROR", repr(e)[:400])
            if verbose:
                print(f"{k:32s} ORACLE_ERROR {repr(e)[:400]}", flush=True)
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        types = type_mismatches(df, rel)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2 and not types
        if types and verbose:
            print("   type mismatches:", types)
        results[k] = ("OK" if ok else "MISMATCH", len(rows), len(orows))
        if verbose:
            print(f"{k:32s} {'OK' if ok else 'MISMATCH'} rows={len(rows)}/{len(orows)} {t_spark:.1f}s", flush=True)
            if not ok:
                if sorted(cols) != sorted(ocols):
                    print("   cols spark :", sorted(cols), "\n   cols oracle:", sorted(ocols))
                s1, s2 = set(l1), set(l2)
                for x in list(s1 - s2)[:3]:
                    print("   only spark :", x[:300])
                for x in list(s2 - s1)[:3]:
                    print("   only oracle:", x[:300])
    return results


if __name__ == "__main__":
    from slicerefresh.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO_ORACLE")}
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
