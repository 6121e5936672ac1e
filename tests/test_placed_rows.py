"""Rows that already lie as a version needs them are not shuffled again; what is written is the same."""

import os

import pytest
from helpers import frame, row, uids

from slicerefresh import TABLE_ORDER, Scope, slice_replace, sync_all, sync_from_snapshot, sync_table
from slicerefresh.plans import incremental
from slicerefresh.plans import sync as sync_mod
from slicerefresh.plans.publish import BucketSpec, publish_table, small_scans, table_bucket_spec, table_location
from slicerefresh.plans.sync import SnapshotFormat, read_snapshot, restore_backup
from slicerefresh.schema import LAYOUTS
from slicerefresh.session import scratch_path
from slicerefresh.sources.delimited import read_manifest

BY_PRACTICE, BY_PROVIDER, BY_LOCATION, BY_MEASURE = TABLE_ORDER
ROWS = [row(k % 7, "AB"[k % 2], f"c{k}", provider_id=str(k % 3), location_id=k % 4) for k in range(40)]
ODD = [row(2, "A", "twice"), row(2, "A", "twice"), row(None, "A", "n"), row(None, None, "n2"), row(3, "B", "dirty", midname="m\x17")]
STAGED = [row(1, "B", "s1"), row(1, "B", "s1"), row(9, "A", "s9"), row(4, "A", "other")]
SCOPE = ([1, 9], ["A", "B"])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _key(df):
    return sorted(repr(sorted(r.asDict().items())) for r in df.collect())


@pytest.fixture
def written(monkeypatch):
    """Plans of the partitioned writes."""
    plans, real = [], incremental._write_partitioned
    monkeypatch.setattr(incremental, "_write_partitioned", lambda df, *a: (plans.append(_plan(df)), real(df, *a))[1])
    return plans


@pytest.mark.parametrize("slices", [None, 4])
@pytest.mark.parametrize("crowded", [False, True])
def test_a_refresh_shuffles_added_rows_only(spark, written, monkeypatch, slices, crowded):
    if crowded:
        monkeypatch.setattr(incremental, "FILES_IN_A_PARTITION", 0)
    name, root = f"placed_{slices}_{crowded}", scratch_path(spark, "placed")
    rows = [*ROWS, row(None, "A", "n")]
    incremental.publish_partitioned(frame(spark, rows), name, root, LAYOUTS[BY_PRACTICE], slices=slices)
    stg, scope = frame(spark, STAGED), Scope.of(*SCOPE).resolve()
    expected = _key(slice_replace(frame(spark, rows), stg, scope))
    incremental.sync_incremental(spark, name, staging=stg, scope=scope, root=root, layout=LAYOUTS[BY_PRACTICE])
    assert _key(spark.table(name)) == expected
    shuffled = written[-1][written[-1].index("Exchange"):]
    assert ("__generation_" in shuffled) == crowded


def test_a_table_that_holds_copies_is_deduplicated_where_it_lies(spark, written):
    root, rows = scratch_path(spark, "placed"), [*ROWS, *ODD]
    incremental.publish_partitioned(frame(spark, rows), "placed_copies", root, LAYOUTS[BY_MEASURE], slices=4)
    stg, scope = frame(spark, STAGED), Scope.of(*SCOPE).resolve()
    incremental.sync_incremental(spark, "placed_copies", staging=stg, scope=scope, root=root, layout=LAYOUTS[BY_MEASURE])
    assert _key(spark.table("placed_copies")) == _key(slice_replace(frame(spark, rows), stg, scope))
    assert "LeftAnti" in written[-1][: written[-1].index("Exchange")]


@pytest.mark.parametrize("slices", [None, 4])
def test_new_tables_of_one_source_are_made_from_the_first(spark, monkeypatch, slices):
    spread, planned = [], []
    real_spread, real_plan = incremental._spread, sync_mod.replacement_plan
    monkeypatch.setattr(incremental, "_spread", lambda *a: (spread.append(1), real_spread(*a))[1])
    monkeypatch.setattr(sync_mod, "replacement_plan", lambda *a, **k: (planned.append(1), real_plan(*a, **k))[1])
    base, cur, stg = scratch_path(spark, "placed"), frame(spark, [*ROWS, *ODD]), frame(spark, STAGED)
    targets = {t: f"one_source_{slices}_{t.rsplit('_', 1)[-1]}" for t in TABLE_ORDER}
    job = {"staging_for": lambda t: stg, "target_for": targets.get, "root_for": lambda t: f"{base}/{t}", "slices": slices}
    report = sync_all(spark, scope=Scope.of(*SCOPE), current_for=lambda t: cur, **job)
    expected = _key(slice_replace(cur, stg, Scope.of(*SCOPE).resolve()))
    assert all(_key(spark.table(n)) == expected for n in targets.values()) and len(spread) + len(planned) == 1
    assert len({r.audit.after_removal for r in report.runs}) == 1 and [r.table for r in report.runs] == list(TABLE_ORDER)
    if not slices:
        specs = [table_bucket_spec(spark, targets[t]) for t in TABLE_ORDER]
        assert {s.columns for s in specs} == {LAYOUTS[BY_PRACTICE].key}
        assert [s.sort_columns for s in specs] == [LAYOUTS[t].key for t in TABLE_ORDER]
    # ... and each is refreshed in place afterwards.
    sync_all(spark, scope=Scope.of([2], ["A"]), current_for=targets.get, **job)
    assert all("twice" not in uids(spark.table(n)) and "s9" in uids(spark.table(n)) for n in targets.values())


def test_a_restore_of_the_tables_own_backup_needs_no_shuffle(spark, monkeypatch):
    base, spec = scratch_path(spark, "placed"), BucketSpec.for_layout(LAYOUTS[BY_LOCATION], 3)
    publish_table(frame(spark, [*ROWS, *ODD]), "placed_restore", f"{base}/t", spec)
    before, stg = _key(spark.table("placed_restore")), frame(spark, STAGED)
    sync_table(spark, BY_LOCATION, current="placed_restore", staging=stg, scope=Scope.of(*SCOPE), target="placed_restore", root=f"{base}/t",
               backup_for=lambda t: f"{base}/backup")
    assert read_manifest(spark, f"{base}/backup")["buckets"] == [3, *spec.columns]

    def refused(df, _spec):
        raise AssertionError("shuffled")

    with monkeypatch.context() as m:
        m.setattr(sync_mod, "bucket_ready", refused)
        restore_backup(spark, BY_LOCATION, backup=f"{base}/backup", target="placed_restore", root=f"{base}/t")
    assert _key(spark.table("placed_restore")) == before
    # Other buckets than the backup's: put in order.
    publish_table(frame(spark, ROWS), "placed_restore_5", f"{base}/t5", BucketSpec.for_layout(LAYOUTS[BY_LOCATION], 5))
    restore_backup(spark, BY_LOCATION, backup=f"{base}/backup", target="placed_restore_5", root=f"{base}/t5")
    assert _key(spark.table("placed_restore_5")) == before


@pytest.mark.parametrize("practices", [[1, 9], [9999]])
def test_a_snapshot_of_a_bucketed_table_keeps_its_buckets(spark, practices):
    base, spec = scratch_path(spark, "placed"), BucketSpec.for_layout(LAYOUTS[BY_MEASURE], 3)
    rows, stg = [*ROWS, *ODD], frame(spark, STAGED)
    name, target = f"placed_source_{practices[0]}", f"placed_target_{practices[0]}"
    publish_table(frame(spark, rows), name, f"{base}/t", spec)
    sync_table(spark, BY_MEASURE, current=name, staging=stg, scope=Scope.of(*SCOPE), target=name, root=f"{base}/t", backup_for=lambda t: f"{base}/backup")
    scope = Scope.of(practices, ["A", "B"])
    job = dict(scope=scope, staging_for=lambda t: stg, target_for=lambda t: target, root_for=lambda t: f"{base}/new", tables=(BY_MEASURE,))
    sync_from_snapshot(spark, snapshot_in_for=lambda t: f"{base}/backup", snapshot_out_for=lambda t: f"{base}/out", **job)
    expected = _key(slice_replace(frame(spark, rows), stg, scope.resolve()))
    assert _key(spark.table(target)) == _key(read_snapshot(spark, f"{base}/out", BY_MEASURE)) == expected
    assert table_bucket_spec(spark, target) == spec and read_manifest(spark, f"{base}/out")["buckets"] == [3, *spec.columns]
    assert all(f.endswith(".zstd.parquet") for f in os.listdir(table_location(spark, target).removeprefix("file:")) if f.startswith("part-"))


def test_a_divided_export_is_written_from_where_the_rows_lie(spark):
    base, stg = scratch_path(spark, "placed"), frame(spark, STAGED)
    fmt = SnapshotFormat(header=True, evolved=True, partitioned=True)
    for current, scope in ((frame(spark, [*ROWS, *ODD]), Scope.of([2], ["A"])), ("placed_export", Scope.of(*SCOPE))):
        sync_table(spark, BY_PROVIDER, current=current, staging=stg, scope=scope, target="placed_export", root=f"{base}/t", slices=4,
                   snapshot_for=lambda t: f"{base}/out", snapshot_format=fmt)
        assert _key(read_snapshot(spark, f"{base}/out", BY_PROVIDER)) == _key(spark.table("placed_export"))


def test_scans_are_small_while_a_job_lasts(spark):
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    with small_scans(spark), small_scans(spark):
        assert int(spark.conf.get(conf)) == 32 << 20
    assert spark.conf.get(conf) == before
