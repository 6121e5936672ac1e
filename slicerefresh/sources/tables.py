"""Table reads and the SQL surface."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from slicerefresh.operators.scope import ResolvedScope


def read_table(spark: SparkSession, source: str | DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table name, a Parquet path, or a DataFrame passed through.

    Catalog tables keep their bucketing, which lets slice removal and
    de-duplication run without a shuffle.
    """
    if isinstance(source, DataFrame):
        df = source
    elif "/" in source or ":" in source:
        df = spark.read.parquet(source)
    else:
        df = spark.table(source)
    return df.select(*columns) if columns else df


def register_views(current: DataFrame, staging: DataFrame, table: str, staging_suffix: str = "_staging") -> tuple[str, str]:
    """Register ``current`` as ``table`` and ``staging`` as ``table + suffix``."""
    current.createOrReplaceTempView(table)
    staging.createOrReplaceTempView(table + staging_suffix)
    return table, table + staging_suffix


def slice_sql(spark: SparkSession, view: str, scope: ResolvedScope) -> DataFrame:
    """``select * from view where k1 in (...) and k2 in (...)`` with the value
    sets bound as parameters, never pasted into the SQL text.

    Every literal value is its own named parameter, so the ``IN`` list still
    reaches the Parquet scan; frame sets are exposed as temp views and used as
    ``IN (subquery)``.
    """
    conds, args = [], {}
    for i, (key, ks) in enumerate(scope.parts.items()):
        if ks.literal:
            names = []
            for j, v in enumerate(v for v in ks.values if v is not None):
                names.append(f":scope_{i}_{j}")
                args[f"scope_{i}_{j}"] = v
            conds.append(f"`{key}` IN ({', '.join(names)})" if names else "false")
        else:
            sub = f"__scope_{view}_{i}"
            ks.frame.createOrReplaceTempView(sub)
            conds.append(f"`{key}` IN (SELECT `{key}` FROM {sub})")
    where = " AND ".join(conds) if conds else "true"
    return spark.sql(f"SELECT * FROM {view} WHERE {where}", args=args)
