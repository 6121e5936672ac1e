"""Predicates as Column expressions.

Everything here is a plain ``pyspark.sql.functions`` expression, so it stays
inside whole-stage codegen and, where Parquet allows it, is pushed to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_clean(column: str | Column, char: str) -> Column:
    """True when ``column`` is null or does not contain ``char``.

    Never null: a null column counts as clean, exactly like
    ``col IS NULL OR NOT col CONTAINS char``.
    """
    c = F.col(column) if isinstance(column, str) else column
    return c.isNull() | ~c.contains(char)


def null_safe_true(predicate: Column) -> Column:
    """``coalesce(predicate, false)``: unknown counts as false.

    Used for the slice predicate, so rows whose keys are null are neither
    removed nor added (three-valued logic made explicit).
    """
    return F.coalesce(predicate, F.lit(False))


def values_in(column: str | Column, values: Iterable) -> Column:
    """``column IN (values)`` on literal values; nulls in ``values`` never match.

    Spark turns long lists into ``InSet`` and Parquet turns them into
    row-group min/max filters, so a literal scope prunes the scan.
    """
    c = F.col(column) if isinstance(column, str) else column
    vals = [v for v in values if v is not None]
    if not vals:
        return F.lit(False)
    return c.isin(vals)
