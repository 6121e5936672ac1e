"""A practice holding a third of all rows must not land in one task or one file."""

from collections import Counter

from helpers import frame, row
from pyspark.sql import functions as F

from slicerefresh.plans.incremental import publish_partitioned
from slicerefresh.plans.publish import BucketSpec, bucket_ready, publish_table
from slicerefresh.schema import LAYOUTS
from slicerefresh.session import scratch_path

LAY = LAYOUTS["summary_details_by_practice"]


def _skewed(spark, n=3000):
    # Practice 1 holds a third of all rows; the rest spread over 200 practices.
    return frame(spark, [row(1 if i % 3 == 0 else 2 + i % 200, "A", f"v{i}") for i in range(n)])


def test_bucketed_layout_spreads_a_hot_practice(spark):
    spec = BucketSpec.for_layout(LAY, 8)
    root = scratch_path(spark, "skew")
    publish_table(bucket_ready(_skewed(spark), spec), "skew_bucketed", f"{root}/t", spec)
    per_file = Counter(r["f"] for r in spark.table("skew_bucketed").select(F.input_file_name().alias("f")).collect())
    sizes = sorted(per_file.values())
    assert len(sizes) == 8
    assert sizes[-1] < 2 * (sum(sizes) / len(sizes))  # no bucket holds much more than its share
    hot = Counter(
        r["f"] for r in spark.table("skew_bucketed").where("practice_id = 1").select(F.input_file_name().alias("f")).collect()
    )
    assert len(hot) == 8  # the hot practice is in every bucket


def test_partitioned_layout_splits_a_hot_practice_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # fixed task count for the assertion
    try:
        root = scratch_path(spark, "skew")
        publish_partitioned(_skewed(spark), "skew_partitioned", f"{root}/t", LAY)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = {r["f"] for r in spark.table("skew_partitioned").where("practice_id = 1").select(F.input_file_name().alias("f")).collect()}
    assert len(files) > 1  # range partitioning on the full key split practice 1 over several writers


def test_a_bucket_of_copies_is_read_as_plain_files(spark, monkeypatch):
    import slicerefresh.plans.publish as publish_mod
    from helpers import uids

    from slicerefresh import Scope, slice_replace, sync_table
    from slicerefresh.plans.publish import buckets_skewed

    monkeypatch.setattr(publish_mod, "SKEW_MIN_ROWS", 0)
    spec = BucketSpec.for_layout(LAY, 8)
    root = scratch_path(spark, "skew")
    uniform = frame(spark, [row(i % 50, "A", f"u{i}") for i in range(400)])
    copies = uniform.unionByName(frame(spark, [row(3, "A", "copy")] * 4000))  # a group of copies: most rows
    publish_table(bucket_ready(uniform, spec), "skew_uniform", f"{root}/u", spec)
    publish_table(bucket_ready(copies, spec), "skew_copies", f"{root}/c", spec)
    assert not buckets_skewed(spark, "skew_uniform")
    assert buckets_skewed(spark, "skew_copies")
    stg = frame(spark, [row(1, "A", "s1")])
    expected = uids(slice_replace(spark.table("skew_copies"), stg, Scope.of([1], ["A"]).resolve()))
    sync_table(spark, "summary_details_by_practice", current="skew_copies", staging=stg, scope=Scope.of([1], ["A"]),
               target="skew_copies", root=f"{root}/c")
    assert uids(spark.table("skew_copies")) == expected and expected.count("copy") == 1
