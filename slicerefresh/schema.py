"""Logical schema of the scored-visit fact and its four key layouts.

One fact (a visit scored against a quality measure) is stored four times,
each copy keyed differently.  A layout is the same logical schema with a
different primary key; physically that becomes a different bucket/sort
order (see ``plans.publish``), never a different set of columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: these must equal the reference's tables ------------------
# Logical column types of the fact, in the order of the reference's DDL.
FACT_TYPES = {
    "practice_id": "int",
    "location_id": "int",
    "provider_id": "string",
    "patient_uid": "string",
    "visit_uid": "string",
    "visit_dt": "timestamp",
    "measure_id": "string",
    "dob": "date",
    "firstname": "string",
    "midname": "string",
    "lastname": "string",
    "gender": "string",
    "mrn": "string",
    "ssn": "string",
    "initial_population": "int",
    "num": "int",
    "num_exception": "int",
    "num_exclusion": "int",
    "denom": "int",
    "denom_exception": "int",
    "denom_exclusion": "int",
    "notmet": "int",
    "created_dt": "timestamp",
    "updated_dt": "timestamp",
    "result": "float",
    "unit": "string",
    "datasource": "int",
}
# Primary key of each layout; the first column is the partition key.
LAYOUT_KEYS = {
    "summary_details_by_practice": ("practice_id", "measure_id", "visit_dt", "unit", "visit_uid"),
    "summary_details_by_provider": ("provider_id", "practice_id", "measure_id", "visit_dt", "unit", "visit_uid"),
    "summary_details_by_location": ("location_id", "practice_id", "measure_id", "visit_dt", "unit", "visit_uid"),
    "summary_details_by_measure": ("measure_id", "visit_dt", "practice_id", "unit", "visit_uid"),
}
# The column added by the one schema-evolution step (absent from old snapshots).
EVOLVED_COLUMN = "datasource"
# The two slice keys: a slice is practice_id in P and measure_id in M.
SLICE_KEYS = ("practice_id", "measure_id")
# Publication order of the four tables.
TABLE_ORDER = (
    "summary_details_by_practice",
    "summary_details_by_provider",
    "summary_details_by_location",
    "summary_details_by_measure",
)
# ---------------------------------------------------------------------------

# Timestamps are stored without time zone: the store keeps wall-clock
# values, and NTZ keeps results independent of the session time zone.
_SPARK_TYPES = {
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "float": T.FloatType(),
}


def spark_type(name: str) -> T.DataType:
    return _SPARK_TYPES[name]


@dataclass(frozen=True)
class Layout:
    """A keyed arrangement of the fact: name, primary key, column order."""

    name: str
    key: tuple[str, ...]

    @property
    def partition_key(self) -> str:
        return self.key[0]

    def columns(self, evolved: bool = True) -> list[str]:
        """Key columns first, then the rest alphabetically (the file rule)."""
        rest = sorted(c for c in FACT_TYPES if c not in self.key)
        if not evolved:
            rest = [c for c in rest if c != EVOLVED_COLUMN]
        return list(self.key) + rest

    def schema(self, evolved: bool = True) -> T.StructType:
        return T.StructType(
            [T.StructField(c, spark_type(FACT_TYPES[c]), True) for c in self.columns(evolved)]
        )

    def wire_schema(self) -> T.StructType:
        """The untyped snapshot schema: the int key stays int, the rest is text."""
        return T.StructType(
            [
                T.StructField(c, T.IntegerType() if c == "practice_id" else T.StringType(), True)
                for c in self.columns(evolved=False)
            ]
        )


LAYOUTS = {name: Layout(name, key) for name, key in LAYOUT_KEYS.items()}


def layout(name: str) -> Layout:
    try:
        return LAYOUTS[name]
    except KeyError:
        raise ValueError(f"unknown table {name!r}; known: {sorted(LAYOUTS)}") from None


def table_schema(name: str, typed: bool = True, evolved: bool = False) -> T.StructType:
    """Schema of a table's delimited snapshot, in its file column order."""
    lay = layout(name)
    return lay.schema(evolved) if typed else lay.wire_schema()


# The one canonical order used for every in-flight frame (the by-practice
# order, which by the file rule already places ``datasource`` after ``created_dt``).
CANONICAL = LAYOUTS["summary_details_by_practice"].columns(evolved=True)
CANONICAL_SCHEMA = LAYOUTS["summary_details_by_practice"].schema(evolved=True)


def conform(
    df: DataFrame,
    schema: T.StructType = CANONICAL_SCHEMA,
    lenient: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Project ``df`` onto ``schema``: fixed order, logical types (and the columns of ``keep`` behind them).

    Columns missing from ``df`` are added as typed nulls (the schema
    evolution step; idempotent).  Extra columns are dropped.  Casts are
    strict (ANSI) unless ``lenient``, which turns bad values into nulls.
    """
    present = {c.lower(): c for c in df.columns}
    cols: list[Column] = []
    for field in schema.fields:
        src = present.get(field.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        current = df.schema[src].dataType
        if current == field.dataType and src == field.name:
            # Plain reference, no alias: keeps the child's partitioning (buckets).
            cols.append(F.col(src))
            continue
        c = F.col(src)
        if current != field.dataType:
            c = c.try_cast(field.dataType) if lenient else c.cast(field.dataType)
        cols.append(c.alias(field.name))
    return df.select(*cols, *keep)


def conform_rejects(df: DataFrame, schema: T.StructType = CANONICAL_SCHEMA) -> Column:
    """Names of a row's columns whose value a lenient ``conform`` would turn into null."""
    present = {c.lower(): c for c in df.columns}
    lost = []
    for field in schema.fields:
        src = present.get(field.name.lower())
        if src is not None and df.schema[src].dataType != field.dataType:
            c = F.col(src)
            lost.append(F.when(c.isNotNull() & c.try_cast(field.dataType).isNull(), F.lit(field.name)))
    return F.filter(F.array(*lost).cast("array<string>"), lambda x: x.isNotNull())


def evolve_schema(df: DataFrame, column: str = EVOLVED_COLUMN, dtype: str = "int") -> DataFrame:
    """Add ``column`` as a typed null if absent; a no-op when it exists."""
    if column.lower() in (c.lower() for c in df.columns):
        return df
    return df.withColumn(column, F.lit(None).cast(spark_type(dtype)))
