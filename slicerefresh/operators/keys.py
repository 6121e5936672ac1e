"""Primary-key checks: the store keeps one row per key.

Both operators aggregate by key with partial (map-side) aggregation, so a
key that holds a third of all rows is reduced inside every map task before
the shuffle; no key's rows are ever gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_check(df: DataFrame, key: Sequence[str], null_keys: bool = False) -> DataFrame:
    """Keys that occur more than once, with their row count ``n_rows``.

    With ``null_keys`` a key with a null part is reported too, however often
    it occurs: a keyed store cannot hold such a row at all.
    """
    bad = F.col("n_rows") > 1
    if null_keys:
        for k in key:
            bad = bad | F.col(k).isNull()
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(bad)


def key_collapse(df: DataFrame, key: Sequence[str], order: Sequence[str] = ("updated_dt",)) -> DataFrame:
    """One row per key: the greatest by ``order`` (nulls lowest), ties broken
    by the remaining columns in their order, also greatest first.

    Same rows as ``row_number() over (partition by key order by o1 desc nulls
    last, ..., c1 desc nulls last, ...) = 1``, but computed as ``max(struct)``:
    an aggregate with a partial step in every map task (Spark plans it as a
    sort aggregate, the struct buffer not being fixed-width), so a hot key
    costs one row per task in the shuffle, not all of its rows in one task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in (*order, *rest)])).alias("__best")
    collapsed = df.groupBy(*key).agg(best)
    return collapsed.select(*[F.col(k) for k in key], *[F.col(f"__best.{c}").alias(c) for c in (*order, *rest)]).select(*df.columns)
