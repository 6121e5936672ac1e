"""Tiny in-memory fact frames for unit tests."""

import datetime as dt

from slicerefresh.schema import CANONICAL, CANONICAL_SCHEMA

SMOKE = "/root/testdata/sf0.001"

T0 = dt.datetime(2020, 1, 1, 10, 0, 0, 123456)


def row(practice, measure, uid, midname="mid", result=1.0, **kw):
    base = {c: None for c in CANONICAL}
    base.update(
        practice_id=practice, measure_id=measure, visit_uid=uid, visit_dt=T0, unit="visit",
        created_dt=T0, updated_dt=T0, midname=midname, result=result, denom=1, num=0,
    )
    base.update(kw)
    return tuple(base[c] for c in CANONICAL)


def frame(spark, rows):
    return spark.createDataFrame(rows, CANONICAL_SCHEMA)


def uids(df):
    return sorted(r["visit_uid"] for r in df.select("visit_uid").collect())
