"""Steps whose cost must not grow faster than the table: deduplication, wide partition columns, exports, buckets."""

import os

import pytest
from helpers import frame, row, uids

from slicerefresh import TABLE_ORDER, Scope, slice_replace, sync_table
from slicerefresh.operators import replace as replace_mod
from slicerefresh.operators.replace import distinct_rows, has_duplicates, has_large_group
from slicerefresh.plans import incremental, publish
from slicerefresh.plans import sync as sync_mod
from slicerefresh.plans.publish import BucketSpec, publish_table, table_bucket_spec
from slicerefresh.plans.sync import SnapshotFormat, read_snapshot, replacement_plan, write_snapshot
from slicerefresh.schema import LAYOUTS
from slicerefresh.session import scratch_path

BY_PRACTICE = TABLE_ORDER[0]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _key(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("limit", [0, 4_000_000])
def test_only_rows_that_may_have_copies_are_shuffled(spark, monkeypatch, limit):
    monkeypatch.setattr(replace_mod, "BROADCAST_REPEATED", limit)
    rows = [row(1, "A", "a"), row(1, "A", "a"), row(None, None, "n"), row(None, None, "n"), row(2, "A", "z", result=0.0),
            row(2, "A", "z", result=-0.0), row(3, "A", "f", result=float("nan")), row(3, "A", "f", result=float("nan")), row(4, "B", "x")]
    df = frame(spark, rows)
    got = distinct_rows(df)
    assert uids(got) == uids(df.distinct()) == ["a", "f", "n", "x", "z"]
    assert has_duplicates(df) and not has_duplicates(got)
    alone = frame(spark, [row(k, "A", f"u{k}") for k in range(20)])
    assert "Exchange" not in _plan(distinct_rows(alone)) and not has_duplicates(alone)
    assert ("LeftAnti" in _plan(got)) == bool(limit)


def test_copies_meet_in_the_shuffle_that_makes_buckets(spark, monkeypatch):
    spec = BucketSpec.for_layout(LAYOUTS[BY_PRACTICE], 4)
    cur = frame(spark, [row(k % 5, "A", f"c{k}") for k in range(20)] + [row(2, "A", "copy")] * 6)
    stg, scope = frame(spark, [row(1, "A", "s")]), Scope.of([1], ["A"]).resolve()
    expected = uids(slice_replace(cur, stg, scope))
    assert expected.count("copy") == 1
    for most in (100, 5):  # within the limit, beyond it
        monkeypatch.setattr(replace_mod, "COPIES_IN_A_TASK", most)
        assert has_large_group(cur, spec.columns) == (most == 5)
        plan = replacement_plan(cur, stg, scope, bucket_spec=spec, removed=4)
        assert uids(plan.result) == expected
        if most == 100:
            assert _plan(plan.kept).count("Exchange") == 1


def test_a_column_of_many_values_is_partitioned_by_slices(spark, monkeypatch):
    monkeypatch.setattr(incremental, "MAX_PARTITIONS", 3)
    monkeypatch.setattr(incremental, "WIDE_SLICES", 8)
    root = scratch_path(spark, "large")
    rows = [row(k, "A", f"a{k}") for k in range(6)] + [row(2, "B", "d"), row(2, "B", "d"), row(None, "A", "n"), row(None, "A", "n")]
    lay = LAYOUTS[BY_PRACTICE]
    few = [r for r in rows if r[0] in (1, 2)]
    incremental.publish_partitioned(frame(spark, few), "large_few", f"{root}/few", lay)
    incremental.publish_partitioned(frame(spark, rows), "large_many", f"{root}/many", lay)
    assert incremental.partition_columns(spark, "large_few") == ["practice_id"]
    assert incremental.partition_columns(spark, "large_many") == [incremental.SLICE_COLUMN]
    assert spark.table("large_many").columns == spark.table("large_few").columns
    stg, scope = frame(spark, [row(1, "A", "s1"), row(9, "A", "s9")]), Scope.of([1, 9], ["A"]).resolve()
    # It removes a row, so that the whole table is de-duplicated.
    incremental.sync_incremental(spark, "large_many", staging=stg, scope=scope, root=f"{root}/many", layout=lay)
    assert uids(spark.table("large_many")) == uids(slice_replace(frame(spark, rows), stg, scope)) == ["a0", "a2", "a3", "a4", "a5", "d", "n", "s1", "s9"]


def test_exports_are_compressed_and_their_files_bounded(spark):
    path = scratch_path(spark, "large")
    df = frame(spark, [row(k, "A", f"u{k}", midname="a~b\n") for k in range(50)])
    write_snapshot(df, path, BY_PRACTICE, SnapshotFormat(header=True, evolved=True))
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert parts and all(f.endswith(".csv.gz") for f in parts)
    assert _key(read_snapshot(spark, path, BY_PRACTICE)) == _key(df)


def test_buckets_of_a_new_target_are_sized_for_a_task(spark, monkeypatch):
    monkeypatch.setattr(sync_mod, "REFRESH_BUCKET_BYTES", 500)
    root = scratch_path(spark, "large")
    publish_table(frame(spark, [row(k, "A", f"u{k}") for k in range(500)]), "large_source", f"{root}/source")
    sync_table(spark, BY_PRACTICE, current="large_source", staging=frame(spark, [row(1, "A", "s")]), scope=Scope.of([1], ["A"]),
               target="large_target", root=f"{root}/target")
    n = -(-publish.stored_bytes(spark, "large_source") // 500)
    assert table_bucket_spec(spark, "large_target").num_buckets == n > spark.sparkContext.defaultParallelism


def test_names_of_versions_sort_by_time():
    names = [publish._version_id()[:-3] for _ in range(200)]  # without the random part
    assert names == sorted(names) and len(set(names)) > 1
    assert publish._VERSION_NAME.match(publish._version_id())
