"""Slice replacement: remove a slice from the current rows, append the staged slice.

    result = DISTINCT? { r in clean(current) : NOT coalesce(S(r), false) }
             UNION ALL  { r in clean(staging) : coalesce(S(r), false) }

The removal keeps set semantics of ``EXCEPT`` -- it also removes duplicates
among the kept rows -- but, as in the reference, only when the slice is
non-empty in ``current`` (``dedupe="reference"``).  Added rows are never
de-duplicated.  Kept and added rows cannot collide on any layout key,
because both slice keys are part of every key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicerefresh.operators.clean import DIRTY_CHAR, DIRTY_COLUMN, control_char_filter
from slicerefresh.operators.scope import ResolvedScope
from slicerefresh.schema import CANONICAL_SCHEMA, conform
from slicerefresh.session import scratch_path

DEDUPE_MODES = ("reference", "always", "never")
#: Up to so many hashes of repeated rows are broadcast (about 100 MB); with more, all rows are shuffled.
BROADCAST_REPEATED = 4_000_000
#: A group of copies of more rows than this, and than so large a share of the table, is not sent to one task as it is.
COPIES_IN_A_TASK = 100_000
SHARE_IN_A_TASK = 1_000
_HASH = "__row_hash"


def slice_select(df: DataFrame, scope: ResolvedScope) -> DataFrame:
    """Rows of ``df`` inside the slice."""
    return scope.select(df)


def _repeated(df: DataFrame) -> tuple[DataFrame, int]:
    """Hashes that more than one row has, and how many they are: only hashes are shuffled.

    Equal rows have equal hashes (``xxhash64`` takes -0.0 for 0.0 and every NaN
    for the same, as DISTINCT does); different rows may share one.
    """
    spark = df.sparkSession
    hashes = df.select(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias(_HASH))
    found = hashes.groupBy(_HASH).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(_HASH)
    path = scratch_path(spark, "repeated")
    found.write.parquet(path)
    kept = spark.read.schema(found.schema).parquet(path)
    return kept, kept.count()


def has_large_group(df: DataFrame, key) -> bool:
    """Whether one ``key`` may have so many rows that a task should not take them all.

    One pass over the key's columns with a sketch of frequent items, which
    never counts a group too low: a table is taken for one with a large group
    rather than the reverse.
    """
    hashes = df.select(F.xxhash64(*[F.col(f"`{c}`") for c in key]).alias(_HASH))
    # The sketch's count is too high by 4 rows in 20,000 at most, a fifth of the share asked for.
    r = hashes.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({_HASH}, 1, 20000)").alias("top")).first()
    return bool(r["top"]) and r["top"][0]["count"] > max(COPIES_IN_A_TASK, r["n"] // SHARE_IN_A_TASK)


def _sharing(df: DataFrame, hashes: DataFrame, how: str) -> DataFrame:
    """Rows whose hash is (``left_semi``) or is not (``left_anti``) one of ``hashes``."""
    return df.join(F.broadcast(hashes), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) == F.col(_HASH), how)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Set semantics over all columns.

    A job over the rows' hashes tells which rows can have a copy.  Only these
    are shuffled and compared, copies meeting in the map tasks already; all
    others stay where they are, so that neither a shuffle nor an aggregate
    holds the whole table.
    """
    alone, some = distinct_parts(df)
    if alone is None or some is None:
        return some if alone is None else alone
    return alone.unionByName(some)


def distinct_parts(df: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """``distinct_rows`` in two parts: rows that stay where they are, and rows that were shuffled; null for no such rows."""
    hashes, n = _repeated(df)
    if n == 0:
        return df, None
    if n > BROADCAST_REPEATED:
        return None, df.distinct()
    return _sharing(df, hashes, "left_anti"), _sharing(df, hashes, "left_semi").distinct()


def has_duplicates(df: DataFrame) -> bool:
    """Whether a row comes twice: among the rows that share a hash, if there are any."""
    hashes, n = _repeated(df)
    if n == 0:
        return False
    some = df if n > BROADCAST_REPEATED else _sharing(df, hashes, "left_semi")
    return not some.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").isEmpty()


def should_dedupe(dedupe: str, removed: int | None, df: DataFrame | None = None, scope: ResolvedScope | None = None) -> bool:
    """Decide whether the kept rows are de-duplicated.

    ``reference``: only when the slice removes at least one row.  ``removed``
    is usually known from the audit; otherwise an existence probe decides
    (it stops at the first matching row).
    """
    if dedupe not in DEDUPE_MODES:
        raise ValueError(f"dedupe must be one of {DEDUPE_MODES}, got {dedupe!r}")
    if dedupe == "always":
        return True
    if dedupe == "never":
        return False
    if removed is None:
        if df is None or scope is None:
            raise ValueError("dedupe='reference' needs the removed count or the frame and scope")
        return not slice_select(df, scope).isEmpty()
    return removed > 0


def slice_delete(df: DataFrame, scope: ResolvedScope, dedupe: str = "reference", removed: int | None = None) -> DataFrame:
    """Rows of ``df`` outside the slice; rows with null keys are kept."""
    kept = scope.exclude(df)
    if should_dedupe(dedupe, removed, df, scope):
        kept = distinct_rows(kept)
    return kept


def slice_append(kept: DataFrame, added: DataFrame, schema=CANONICAL_SCHEMA) -> DataFrame:
    """UNION ALL by name after projecting both sides onto one typed schema."""
    return conform(kept, schema).unionByName(conform(added, schema))


def slice_replace(
    current: DataFrame,
    staging: DataFrame,
    scope: ResolvedScope,
    *,
    dedupe: str = "reference",
    removed: int | None = None,
    clean_column: str | None = DIRTY_COLUMN,
    clean_char: str = DIRTY_CHAR,
    schema=CANONICAL_SCHEMA,
) -> DataFrame:
    """Current rows with the slice replaced by the staged rows of the same slice."""
    cur, stg = conform(current, schema), conform(staging, schema)
    if clean_column:
        cur = control_char_filter(cur, clean_column, clean_char)
        stg = control_char_filter(stg, clean_column, clean_char)
    kept = slice_delete(cur, scope, dedupe, removed)
    added = slice_select(stg, scope)
    return slice_append(kept, added, schema)
