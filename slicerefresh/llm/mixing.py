"""Mixing sources to target weights by Pareto order sampling.

Sources share a budget of words by weight (``water_fill``: no source above a
multiple of its own size, the excess reshared).  Within a source, documents of
one length class share an expected number of copies that falls with the
logarithm of the length, so that long documents do not crowd out the others;
the expectations are filled up to the source's target the same way.  Of an
expectation ``e``, ``floor(e)`` copies are certain.  The remaining fraction
``p`` is the inclusion probability of one more copy, drawn by Pareto order
sampling: documents are ranked by ``(u / (1-u)) / (p / (1-p))`` with a random
``u`` that a hash of the id fixes, and taken in rank order until the words of
the source's target are reached.  The sample has a fixed size in words to
within half a document, with unequal inclusion probabilities.

All statistics are sums per source and class; the running sum over a source's
ranks is taken within range partitions and then shifted by the sums of the
partitions before, so that a source of any size is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicerefresh.llm.shared import written

#: Weights of the sources in code-point order, repeating (null source last).
WEIGHTS = (5, 2, 1)
#: Words of the mix, as a share of all words, and copies of a source or document at most.
TOTAL_SHARE, MAX_COPIES = 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
#: The weight of a document is this less the bits of its size.
LEVELS = 64


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(df: DataFrame, group: list[str], total: Column) -> DataFrame:
    """Add ``level``: the amount per weight at which ``sum(least(cap, weight * level))`` is ``total``.

    ``df`` has one row per item with whole numbers ``weight`` and ``cap``.
    Items are filled in the order of cap to weight; the first item that its
    share of the rest does not fill, and all after it, get the same level.
    """
    order = Window.partitionBy(*group).orderBy(F.col("cap") / F.col("weight"), "weight", "cap")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    full = F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (total - full) / rest
    stepped = df.withColumn("__level", level).withColumn("__open", F.col("weight") * F.col("__level") < F.col("cap"))
    found = F.max(F.when(F.col("__open"), F.col("__level"))).over(whole)  # later items assume too much filled: less
    return stepped.withColumn("level", found).drop("__level", "__open")


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the id's MD5."""
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def _placed(rows: DataFrame, plan: DataFrame, sums: DataFrame) -> DataFrame:
    """Rows (``__source, __size, __bits``) with their class's plan and their source's sums."""
    p = plan.select(*[F.col(c).alias(f"__p_{c}") for c in plan.columns])
    s = sums.select(*[F.col(c).alias(f"__s_{c}") for c in sums.columns])
    # One row per source and length class (at most 64) resp. per source, far fewer than documents, so that
    # a broadcast leaves the rows of a large source where they are; without it Spark splits its partitions.
    if plan.count() <= BROADCAST_CLASSES:
        p, s = F.broadcast(p), F.broadcast(s)
    rows = rows.join(p, F.col("__source").eqNullSafe(F.col("__p_source")) & (F.col("__bits") == F.col("__p_bits")) & (F.col("__size") > 0), "left")
    return rows.join(s, F.col("__source").eqNullSafe(F.col("__s_source")), "left")


def _rank(doc_id: Column) -> Column:
    """Random odds by inclusion odds; null without a chance of one more copy."""
    part = F.col("__p_expected") - F.col("__p_certain")
    u = uniform(doc_id)
    return F.when(part > 0, (u / (1 - u)) / (part / (1 - part)))


BROADCAST_CLASSES = 500_000


def _sized(docs: DataFrame, text_col: str, source_col: str) -> DataFrame:
    rows = docs.withColumns({"__source": F.col(source_col), "__size": n_words(F.col(text_col))})
    return rows.withColumn("__bits", F.length(F.bin("__size")))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Per source and length class the expected copies, per source its sums, target and the last rank taken."""
    rows = _sized(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"), F.col(source_col).alias("__from")), "__text", "__from")
    rows = written(rows.select("doc_id", "__source", "__size", "__bits"), "mix-sizes")
    classes = rows.groupBy(F.col("__source").alias("source"), F.col("__bits").alias("bits")).agg(F.sum("__size").alias("class_size"))
    classes = written(classes, "mix-classes")
    sources = classes.groupBy("source").agg(F.sum("class_size").alias("source_size"))

    by_code = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = (F.row_number().over(by_code) - 1) % len(WEIGHTS)
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), place + 1).cast("long"))
    sources = sources.withColumn("cap", MAX_COPIES * F.col("source_size")).withColumn("one", F.lit(1))
    everything = TOTAL_SHARE * F.sum("source_size").over(Window.partitionBy("one"))
    sources = water_fill(sources, ["one"], everything)
    sources = sources.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"))
    sources = written(sources, "mix-targets")

    classes = classes.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    classes = classes.withColumn("level_weight", LEVELS - F.col("bits")).withColumn("weight", F.col("level_weight") * F.col("class_size"))
    classes = classes.withColumn("cap", MAX_COPIES * F.col("class_size")).filter("class_size > 0")
    classes = water_fill(classes, ["source"], F.col("target"))
    expected = F.least(F.lit(float(MAX_COPIES)), F.coalesce(F.col("level_weight") * F.col("level"), F.lit(float(MAX_COPIES))))
    classes = classes.withColumn("expected", expected).withColumn("certain", F.floor("expected"))
    certain_words = F.sum(F.col("certain") * F.col("class_size")).over(Window.partitionBy("source"))
    classes = classes.withColumn("quota", F.col("target") - certain_words)
    plan = written(classes.select("source", "bits", "expected", "certain", "quota"), "mix-plan")

    ranked = _placed(rows, plan, sources).withColumn("rank", _rank(F.col("doc_id"))).filter("rank is not null")
    ranked = ranked.select("doc_id", F.col("__source").alias("source"), F.col("__size").alias("size"), F.col("__p_quota").alias("quota"), "rank")
    ranked = ranked.repartitionByRange("source", "rank", "doc_id", "size").withColumn("part", F.spark_partition_id())
    ranked = written(ranked, "mix-ranks")
    sizes = ranked.groupBy("part", "source").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per source and range partition.
    sizes = sizes.select(F.col("part").alias("o_part"), F.col("source").alias("o_source"), F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("before"))
    joined = ranked.join(sizes, (F.col("part") == F.col("o_part")) & F.col("source").eqNullSafe(F.col("o_source")))
    run = Window.partitionBy("part", "source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto = joined.withColumn("upto", F.col("before") + F.sum("size").over(run))
    taken = upto.filter(F.col("upto") - F.col("size") / 2 <= F.col("quota"))
    cuts = taken.groupBy(F.col("source").alias("c")).agg(F.max(F.struct("rank", "doc_id", "size")).alias("last"))
    sources = sources.join(cuts, F.col("source").eqNullSafe(F.col("c")), "left").drop("c")
    return plan, written(sources, "mix-sources")


def copies_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents with ``__copies, __size, __source_size, __target`` as further columns."""
    plan, sources = plan_mix(docs, id_col, text_col, source_col)
    rows = _placed(_sized(docs, text_col, source_col), plan, sources)
    last = F.struct(_rank(F.col(id_col)).alias("rank"), F.col(id_col).alias("doc_id"), F.col("__size").alias("size"))
    extra = F.when(last["rank"].isNotNull() & (last <= F.col("__s_last")), 1).otherwise(0)
    copies = (F.coalesce("__p_certain", F.lit(0)) + extra).cast("long")
    return rows.select(*docs.columns, copies.alias("__copies"), "__size", F.col("__s_source_size").alias("__source_size"), F.col("__s_target").alias("__target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken.

    ``size`` counts words; null text counts none.  A null source is a source of
    its own, last.  Rows with one id and source share their random number and
    are ranked by size after that; rows equal in all of it fall on one side of
    the cut together.  Documents without words take no copies.  An empty table
    gives no rows.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    rows = copies_of(rows)
    return rows.select(
        "doc_id", "source", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        F.col("__copies").alias("copies"), (F.col("__copies") * F.col("__size")).alias("taken"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents that the mix takes, with their columns and ``copies`` (which replaces a column of that name)."""
    rows = copies_of(docs, id_col, text_col, source_col).filter("__copies > 0")
    return rows.select(*[c for c in docs.columns if c != "copies"], F.col("__copies").alias("copies"))
