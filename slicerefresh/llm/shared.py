"""Helpers of the operators: written tables, hot keys, the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicerefresh.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{tag}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: ``crc32(doc_id as text) mod 4 = 2`` (null id: empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


#: A key is hot when it holds more than one in so many rows; so at most this many keys are hot.
HOT_PARTS = 10_000


def join_hot(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Inner join of rows to one row per key in ``groups``, whose ``size`` counts the rows of the key.

    Keys with more than ``total / HOT_PARTS`` rows are at most ``HOT_PARTS``
    many, so that their side is broadcast and their rows stay where they are;
    all others are joined by a shuffle in which no key is large.
    """
    hot = groups.filter(F.col(size) * HOT_PARTS > total)
    cold = groups.filter(F.col(size) * HOT_PARTS <= total)
    return rows.join(F.broadcast(hot), keys).unionByName(rows.join(cold, keys))


#: Up to so many ids of rows to drop are broadcast (about 50 MB); more are dropped by a shuffle.
BROADCAST_DROPS = 500_000


def unique_ids(ids: DataFrame, id_col: str = "doc_id") -> bool:
    """Whether no id (null included) comes twice."""
    return ids.groupBy(id_col).count().filter("count > 1").isEmpty()


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not in ``dropped(drop_id)``; null is an id like others."""
    dropped = written(dropped.select(F.col("drop_id")), "drops")
    side = F.broadcast(dropped) if dropped.count() <= BROADCAST_DROPS else dropped
    return docs.join(side, docs[id_col].eqNullSafe(side["drop_id"]), "left_anti")
