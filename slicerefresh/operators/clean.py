"""Removal of dirty rows: a value holding a control character."""

from __future__ import annotations

from pyspark.sql import DataFrame

from slicerefresh.functions.predicates import is_clean

# --- Fixed values: the dirty-row marker of the reference ---------------------
DIRTY_COLUMN = "midname"
DIRTY_CHAR = "\x17"  # U+0017, END OF TRANSMISSION BLOCK
# ---------------------------------------------------------------------------


def control_char_filter(df: DataFrame, column: str = DIRTY_COLUMN, char: str = DIRTY_CHAR) -> DataFrame:
    """Keep rows whose ``column`` is null or does not contain ``char``.

    A narrow filter: it fuses into the scan's codegen stage.  It commutes
    with union and slice removal, so applying it once per input suffices.
    """
    return df.filter(is_clean(column, char))
