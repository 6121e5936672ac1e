"""Per-practice "data up to" status, advanced from a published result.

The reference collects the high-water marks to the driver and issues one
UPDATE per practice.  Here the update is a table-to-table operation: the
status table is left-joined with the high-water marks and republished.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicerefresh.operators.scope import ResolvedScope

# --- Fixed values: the reference's status table -----------------------------
STATUS_KEY = "practiceid"
STATUS_END = "enddate"
STATUS_REFRESHED = "lastrefreshtime"
# ---------------------------------------------------------------------------


def practice_filter(df: DataFrame, scope: ResolvedScope, key: str = "practice_id") -> DataFrame:
    """Rows whose practice is in the scope's practice set (all measures)."""
    return ResolvedScope({key: scope.parts[key]}).select(df)


def practice_high_water(df: DataFrame, key: str = "practice_id", ts: str = "visit_dt") -> DataFrame:
    """Latest ``ts`` per practice, as ``(practice_id, enddate)``.

    No DISTINCT before the max: it would not change the result and would add
    a shuffle of every (practice, ts) pair.
    """
    return df.groupBy(key).agg(F.max(ts).alias(STATUS_END))


def refresh_status(
    status: DataFrame,
    high_water: DataFrame,
    refreshed_at: Column | None = None,
    key: str = "practice_id",
) -> DataFrame:
    """UPDATE semantics: matched practices get the new end date (even if it
    is older or null) and the refresh time; unmatched status rows stay as
    they are; practices without a status row are ignored.
    """
    if refreshed_at is None:
        refreshed_at = F.localtimestamp()
    hw = high_water.select(F.col(key).alias("__hw_key"), F.col(STATUS_END).alias("__hw_end"), F.lit(True).alias("__hw_hit"))
    joined = status.join(hw, status[STATUS_KEY] == hw["__hw_key"], "left")
    hit = F.coalesce(F.col("__hw_hit"), F.lit(False))
    end_type = status.schema[STATUS_END].dataType
    ref_type = status.schema[STATUS_REFRESHED].dataType
    out = []
    for c in status.columns:
        if c == STATUS_END:
            out.append(F.when(hit, F.col("__hw_end").cast(end_type)).otherwise(F.col(c)).alias(c))
        elif c == STATUS_REFRESHED:
            out.append(F.when(hit, refreshed_at.cast(ref_type)).otherwise(F.col(c)).alias(c))
        else:
            out.append(status[c])
    return joined.select(*out)
