"""Incremental publish: only the partitions in scope change, with the full refresh's rows."""

import pytest
from helpers import frame, row, uids

from slicerefresh import Scope, slice_replace
from slicerefresh.plans import generations
from slicerefresh.plans.generations import partition_names
from slicerefresh.plans.incremental import (
    DISTINCT_PROPERTY,
    NotIncremental,
    _partition_location,
    publish_partitioned,
    stage_incremental,
    switch_partitions,
    sync_incremental,
    table_properties,
)
from slicerefresh.plans.publish import PublishError, prune_versions
from slicerefresh.schema import LAYOUTS
from slicerefresh.session import scratch_path

LAY = LAYOUTS["summary_details_by_practice"]


def _start(spark, name, rows):
    root = scratch_path(spark, "inc")
    publish_partitioned(frame(spark, rows), name, f"{root}/{name}", LAY)
    return f"{root}/{name}"


def test_only_scoped_partitions_move_and_rows_match_full_refresh(spark):
    rows = [row(1, "A", "a1"), row(1, "B", "b1"), row(2, "A", "a2"), row(None, "A", "n")]
    root = _start(spark, "inc_basic", rows)
    before = {p: _partition_location(spark, "inc_basic", "practice_id", p) for p in (1, 2)}
    stg = frame(spark, [row(1, "A", "s1"), row(3, "A", "s3")])
    scope = Scope.of([1, 3], ["A"]).resolve()
    run = sync_incremental(spark, "inc_basic", staging=stg, scope=scope, root=root, layout=LAY)
    full = slice_replace(frame(spark, rows), stg, scope)
    assert uids(spark.table("inc_basic")) == uids(full) == ["a2", "b1", "n", "s1", "s3"]
    assert _partition_location(spark, "inc_basic", "practice_id", 2) == before[2]  # untouched, not rewritten
    assert _partition_location(spark, "inc_basic", "practice_id", 1) != before[1]
    assert run.audit.to_remove == 1 and run.audit.after_add == 3 and run.distinct


def test_emptied_partition_is_dropped(spark):
    root = _start(spark, "inc_empty", [row(1, "A", "a1"), row(2, "A", "a2")])
    sync_incremental(spark, "inc_empty", staging=frame(spark, []), scope=Scope.of([1], ["A"]).resolve(),
                     root=root, layout=LAY)
    assert uids(spark.table("inc_empty")) == ["a2"]
    assert partition_names(spark, "inc_empty") == {"practice_id=2"}


def test_refuses_when_the_whole_table_would_need_deduplication(spark):
    root = _start(spark, "inc_dups", [row(1, "A", "a1"), row(2, "A", "d"), row(2, "A", "d")])
    assert table_properties(spark, "inc_dups")[DISTINCT_PROPERTY] == "false"
    with pytest.raises(NotIncremental):
        sync_incremental(spark, "inc_dups", staging=frame(spark, []), scope=Scope.of([1], ["A"]).resolve(),
                         root=root, layout=LAY)
    # Nothing removed: no dedupe needed, so the refresh is exact and allowed.
    sync_incremental(spark, "inc_dups", staging=frame(spark, [row(3, "A", "s3")]),
                     scope=Scope.of([3], ["A"]).resolve(), root=root, layout=LAY)
    assert uids(spark.table("inc_dups")) == ["a1", "d", "d", "s3"]


def test_duplicate_staged_rows_clear_the_distinct_property(spark):
    root = _start(spark, "inc_flag", [row(1, "A", "a1")])
    sync_incremental(spark, "inc_flag", staging=frame(spark, [row(1, "A", "s"), row(1, "A", "s")]),
                     scope=Scope.of([1], ["A"]).resolve(), root=root, layout=LAY)
    assert table_properties(spark, "inc_flag")[DISTINCT_PROPERTY] == "false"
    assert uids(spark.table("inc_flag")) == ["s", "s"]


def test_failed_partition_switch_is_undone(spark, monkeypatch):
    rows = [row(1, "A", "a1"), row(2, "A", "a2")]
    root = _start(spark, "inc_undo", rows)
    before = {p: _partition_location(spark, "inc_undo", "practice_id", p) for p in (1, 2)}
    real_sql = spark.sql

    def failing_sql(query, *a, **k):
        if "SET TBLPROPERTIES" in query:
            raise RuntimeError("injected catalog failure")
        return real_sql(query, *a, **k)

    monkeypatch.setattr(spark, "sql", failing_sql)
    with pytest.raises(RuntimeError):
        sync_incremental(spark, "inc_undo", staging=frame(spark, [row(3, "A", "s3")]),
                         scope=Scope.of([1, 2, 3], ["A"]).resolve(), root=root, layout=LAY)
    monkeypatch.undo()
    assert {p: _partition_location(spark, "inc_undo", "practice_id", p) for p in (1, 2)} == before
    assert partition_names(spark, "inc_undo") == {"practice_id=1", "practice_id=2"}
    assert uids(spark.table("inc_undo")) == ["a1", "a2"]


def test_sync_all_refreshes_partitioned_tables_incrementally(spark):
    from slicerefresh import TABLE_ORDER, StatusTarget, sync_all
    from pyspark.sql import functions as F
    from slicerefresh.plans.publish import publish_table
    import datetime as dt

    root = scratch_path(spark, "inc")
    rows = [row(1, "A", "a1"), row(1, "B", "b1"), row(2, "A", "a2")]
    targets = {t: f"inc_all_{t.rsplit('_', 1)[-1]}" for t in TABLE_ORDER}
    for t in TABLE_ORDER:
        publish_partitioned(frame(spark, rows), targets[t], f"{root}/{t}", LAYOUTS[t])
    untouched = _partition_location(spark, targets[TABLE_ORDER[0]], "practice_id", 2)
    status = spark.createDataFrame([(1, dt.datetime(1990, 1, 1), dt.datetime(1990, 1, 1))],
                                   "practiceid int, enddate timestamp_ntz, lastrefreshtime timestamp_ntz")
    publish_table(status, "inc_all_status", f"{root}/status")
    stg = frame(spark, [row(1, "A", "s1", visit_dt=dt.datetime(2030, 5, 5))])
    report = sync_all(
        spark, scope=Scope.of([1], ["A"]), current_for=lambda t: targets[t], staging_for=lambda t: stg,
        target_for=lambda t: targets[t], root_for=lambda t: f"{root}/{t}", snapshot_for=lambda t: f"{root}/snap/{t}",
        status=StatusTarget("inc_all_status", f"{root}/status", F.lit("2031-01-01 00:00:00").cast("timestamp_ntz")),
    )
    for t in TABLE_ORDER:
        assert uids(spark.table(targets[t])) == ["a2", "b1", "s1"]
    assert _partition_location(spark, targets[TABLE_ORDER[0]], "practice_id", 2) == untouched
    assert [r.audit.after_add for r in report.runs] == [2, 2, 2, 2]
    assert spark.table("inc_all_status").first()["enddate"] == dt.datetime(2030, 5, 5)
    assert spark.read.option("header", "true").option("sep", "~").csv(f"{root}/snap/{TABLE_ORDER[0]}").count() == 3


def test_distributed_practice_scope_of_any_size(spark, monkeypatch):
    """A distributed scope has no bound: values beyond the literal limit are joined and switched in batches."""
    monkeypatch.setattr(generations, "LITERAL_VALUES", 1)
    rows = [row(1, "A", "a1"), row(2, "A", "a2"), row(3, "A", "a3"), row(None, "A", "n")]
    root = _start(spark, "inc_frame", rows)
    stg = frame(spark, [row(1, "A", "s1"), row(3, "A", "s3"), row(4, "A", "s4")])
    scope = Scope.of(None, ["A"]).resolve(stg, max_literal_values=0)  # practices stay a distributed frame
    assert not scope.parts["practice_id"].literal
    sync_incremental(spark, "inc_frame", staging=stg, scope=scope, root=root, layout=LAY)
    assert uids(spark.table("inc_frame")) == uids(slice_replace(frame(spark, rows), stg, scope)) == ["a2", "n", "s1", "s3", "s4"]


def test_pruning_keeps_every_partition(spark):
    root = _start(spark, "inc_keep", [row(p, "A", f"r{p}") for p in range(6)])
    for p in range(4):  # each refresh leaves its partition in a version of its own
        sync_incremental(spark, "inc_keep", staging=frame(spark, [row(p, "A", f"s{p}")]), scope=Scope.of([p], ["A"]).resolve(), root=root, layout=LAY)
    sync_incremental(spark, "inc_keep", staging=frame(spark, [row(0, "A", "t0")]), scope=Scope.of([0], ["A"]).resolve(), root=root, layout=LAY)
    deleted = prune_versions(spark, "inc_keep", root, keep=0)
    assert len(deleted) == 1  # the replaced version of practice 0 only
    spark.catalog.refreshTable("inc_keep")
    assert uids(spark.table("inc_keep")) == ["r4", "r5", "s1", "s2", "s3", "t0"]


def test_a_refresh_staged_from_an_older_version_is_refused(spark):
    root = _start(spark, "inc_lost", [row(1, "A", "a1"), row(2, "A", "a2")])
    jobs = [
        stage_incremental(spark, "inc_lost", staging=frame(spark, [row(p, "A", f"s{p}")]), scope=Scope.of([p], ["A"]).resolve(), root=root, layout=LAY)
        for p in (1, 2)
    ]
    switch_partitions(spark, jobs[0])
    with pytest.raises(PublishError, match="stage it again"):
        switch_partitions(spark, jobs[1])
    assert uids(spark.table("inc_lost")) == ["a2", "s1"]


def test_the_clean_flag_names_what_was_cleaned(spark):
    root = scratch_path(spark, "inc")
    publish_partitioned(frame(spark, [row(1, "A", "a1", midname="x" + chr(23)), row(2, "A", "a2")]), "inc_clean_of", root, LAY, clean_column="lastname")
    with pytest.raises(NotIncremental, match="lastname"):
        sync_incremental(spark, "inc_clean_of", staging=frame(spark, []), scope=Scope.of([2], ["A"]).resolve(), root=root, layout=LAY)


def test_partition_values_with_special_characters(spark):
    root = scratch_path(spark, "inc")
    rows = [row(1, "A/B", "a1"), row(1, "C=%41 d", "a2"), row(2, "E'f", "a3")]
    publish_partitioned(frame(spark, rows), "inc_odd", root, LAYOUTS["summary_details_by_measure"], partition_col="measure_id")
    stg = frame(spark, [row(1, "A/B", "s1"), row(2, "E'f", "s3"), row(3, "g:h", "s4")])
    scope = Scope.of([1, 2, 3], ["A/B", "E'f", "g:h"]).resolve()
    for _ in range(2):  # the second refresh finds what the first one switched
        sync_incremental(spark, "inc_odd", staging=stg, scope=scope, root=root, layout=LAYOUTS["summary_details_by_measure"])
        assert uids(spark.table("inc_odd")) == ["a2", "s1", "s3", "s4"]


def test_reading_the_touched_partitions_prunes_the_rest(spark):
    from pyspark.sql import functions as F

    from slicerefresh.schema import conform

    _start(spark, "inc_prune", [row(p, "A", f"r{p}") for p in range(6)])
    current = conform(spark.table("inc_prune")).where(F.col("practice_id").isin([1, 4]))
    p = current._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in p and "practice_id" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert "(2 paths)" in p  # two partition folders listed out of six
