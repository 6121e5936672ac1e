"""Tables and status move together; counts do not depend on how often tasks ran; scopes and layouts."""

import datetime as dt
import subprocess
import sys

import pytest
from helpers import frame, row, uids
from pyspark.sql import functions as F

from slicerefresh import Scope, StatusTarget, layout_write, slice_select, sync_all
from slicerefresh.operators.scope import distinct_keys
from slicerefresh.plans.incremental import publish_partitioned
from slicerefresh.plans.publish import BucketSpec, layout_report, publish_table, table_location
from slicerefresh.schema import LAYOUTS, TABLE_ORDER
from slicerefresh.session import scratch_path

OLD, NEW = dt.datetime(1990, 1, 1), dt.datetime(2030, 5, 5)
REFRESHED = "timestamp_ntz'2031-01-01 00:00:00'"


def _group(spark, tag, partitioned):
    root = scratch_path(spark, "group")
    rows = [row(1, "A", "c1"), row(2, "A", "c2")]
    targets = {t: f"{tag}_{t.rsplit('_', 1)[-1]}" for t in TABLE_ORDER}
    for t in TABLE_ORDER:
        if partitioned:
            publish_partitioned(frame(spark, rows), targets[t], f"{root}/{t}", LAYOUTS[t], slices=8)
        else:
            publish_table(frame(spark, rows), targets[t], f"{root}/{t}", BucketSpec.for_layout(LAYOUTS[t], 2))
    status = spark.createDataFrame([(1, OLD, OLD)], "practiceid int, enddate timestamp_ntz, lastrefreshtime timestamp_ntz")
    publish_table(status, f"{tag}_status", f"{root}/status")
    return dict(
        scope=Scope.of([1], ["A"]), current_for=lambda t: targets[t], staging_for=lambda t: frame(spark, [row(1, "A", "s1", visit_dt=NEW)]),
        target_for=lambda t: targets[t], root_for=lambda t: f"{root}/{t}", status=StatusTarget(f"{tag}_status", f"{root}/status", F.expr(REFRESHED)),
    ), targets


def _state(spark, tag, targets):
    return [uids(spark.table(n)) for n in targets.values()], [tuple(r) for r in spark.table(f"{tag}_status").collect()]


BEFORE = ([["c1", "c2"]] * 4, [(1, OLD, OLD)])
AFTER = ([["c2", "s1"]] * 4, [(1, NEW, dt.datetime(2031, 1, 1))])


@pytest.mark.parametrize(
    "partitioned, step", [(False, "stage_status"), (False, "switch_status"), (False, "switch_table"), (True, "switch_status"), (True, "switch_table")]
)
def test_a_failure_anywhere_leaves_tables_and_status_old(spark, monkeypatch, partitioned, step):
    import slicerefresh.plans.sync as sync_mod

    tag = f"grp_{step}_{int(partitioned)}"
    kw, targets = _group(spark, tag, partitioned)
    real_switch, real_flip, flips = sync_mod.switch, sync_mod.flip_partitions, []

    def fail(*a, **k):
        raise RuntimeError("injected")

    def switch(spark_, staged):
        if step == "switch_status" and staged.table.endswith("_status"):
            real_switch(spark_, staged)  # even after it took effect
            fail()
        if step == "switch_table" and staged.table.endswith("_measure"):
            fail()
        return real_switch(spark_, staged)

    def flip(spark_, sw):
        flips.append(sw)
        if step == "switch_table" and len(flips) == 4:
            fail()
        real_flip(spark_, sw)

    monkeypatch.setattr(sync_mod, "switch", switch)
    monkeypatch.setattr(sync_mod, "flip_partitions", flip)
    if step == "stage_status":
        monkeypatch.setattr(sync_mod, "stage_status", fail)
    with pytest.raises(RuntimeError, match="injected"):
        sync_all(spark, **kw)
    monkeypatch.undo()
    assert _state(spark, tag, targets) == BEFORE
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(tag) and "__staged_" in t.name]
    report = sync_all(spark, **kw)
    assert _state(spark, tag, targets) == AFTER
    assert report.status.rows == 1 and report.status.path == table_location(spark, f"{tag}_status").replace("file:", "")


def test_staging_that_changes_during_a_refresh_is_read_as_it_was(spark, monkeypatch):
    import slicerefresh.plans.sync as sync_mod

    kw, targets = _group(spark, "grp_pin", False)
    root = scratch_path(spark, "group")
    publish_table(frame(spark, [row(1, "A", "s1"), row(2, "B", "other")]), "grp_pin_staging", f"{root}/staging")
    real = sync_mod.input_counts

    def counts(*a):
        out = real(*a)
        publish_table(frame(spark, [row(1, "A", f"later{k}") for k in range(5)]), "grp_pin_staging", f"{root}/staging")
        return out

    monkeypatch.setattr(sync_mod, "input_counts", counts)
    sync_all(spark, **{**kw, "staging_for": lambda t: "grp_pin_staging", "scope": Scope.of(None, ["A"]), "status": None, "parallel_tables": 1})
    assert [uids(spark.table(n)) for n in targets.values()] == [["s1"]] * 4  # practices 1 and 2 of the first version


RETRIED = """
import sys
sys.path[:0] = [{repo!r}, {tests!r}]
from helpers import frame, row, uids
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from slicerefresh import Scope, sync_all
from slicerefresh.plans.publish import BucketSpec, publish_table
from slicerefresh.schema import LAYOUTS

spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.warehouse.dir", {root!r} + "/wh").config("spark.checkpoint.dir", {root!r} + "/cp").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
T = "summary_details_by_practice"

@F.udf("string")
def flaky(x):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")
    return x

rows = [row(p, m, f"{{p}}{{m}}{{k}}") for p in range(4) for m in "AB" for k in range(5)]
publish_table(frame(spark, rows), "t", {root!r} + "/t", BucketSpec.for_layout(LAYOUTS[T], 4))
staging = frame(spark, [row(1, "A", f"s{{k}}") for k in range(7)]).repartition(3).withColumn("visit_uid", flaky("visit_uid"))
report = sync_all(spark, scope=Scope.of([1, 2], ["A"]), current_for=lambda t: "t", staging_for=lambda t: staging, target_for=lambda t: "t",
                  root_for=lambda t: {root!r} + "/t", tables=(T,))
a = report.runs[0].audit
print("COUNTS", a.prod_full, a.to_remove, a.to_add, a.after_removal, a.after_add, len(uids(spark.table("t"))))
"""


def test_retried_tasks_change_no_count(tmp_path):
    import os

    tests = os.path.dirname(os.path.abspath(__file__))
    code = RETRIED.format(repo=os.path.dirname(tests), tests=tests, root=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert "COUNTS 40 10 7 30 37 37" in out.stdout, out.stderr[-2000:]


# --- scopes ------------------------------------------------------------------------


def test_both_keys_of_staging_come_from_one_scan(spark):
    root = scratch_path(spark, "group")
    frame(spark, [row(1, "A", "a"), row(2, None, "b"), row(None, "C", "c"), row(None, None, "d"), row(1, "A", "e")]).write.parquet(f"{root}/stg")
    stg = spark.read.parquet(f"{root}/stg")
    found = distinct_keys(stg, ["practice_id", "measure_id"])
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([(0, 1, None), (0, 2, None), (1, None, "A"), (1, None, "C")], key=repr)
    for limit in (0, 1000):
        scope = Scope.of(None, None).resolve(stg, max_literal_values=limit)
        assert (scope.size("practice_id"), scope.size("measure_id")) == (2, 2)
        assert sorted(r[0] for r in scope.key_frame("practice_id").collect()) == [1, 2]
        assert uids(slice_select(stg, scope)) == ["a", "e"]


def test_the_job_reads_shared_staging_once(spark, monkeypatch):
    from slicerefresh.operators import scope as scope_mod
    from slicerefresh.plans.sync import resolve_scope

    root = scratch_path(spark, "group")
    frame(spark, [row(1, "A", "a")]).write.parquet(f"{root}/stg")
    passes, real = [], scope_mod.distinct_keys
    monkeypatch.setattr(scope_mod, "distinct_keys", lambda df, keys: passes.append(keys) or real(df, keys))
    resolve_scope(spark, Scope.of(None, None), lambda t: f"{root}/stg")
    assert passes == [["practice_id", "measure_id"]]


def test_scopes_beyond_both_limits_are_shuffled_with_a_bloom_filter(spark):
    root = scratch_path(spark, "group")
    frame(spark, [row(p, "A", f"c{p}") for p in range(200)]).write.parquet(f"{root}/cur")
    frame(spark, [row(p, "A", f"s{p}") for p in range(50)]).write.parquet(f"{root}/stg")
    cur, stg = spark.read.parquet(f"{root}/cur"), spark.read.parquet(f"{root}/stg")
    for limits in (dict(max_broadcast_keys=1), dict(max_broadcast_bytes=1)):
        scope = Scope.of(None, ["A"]).resolve(stg, max_literal_values=0, **limits)
        assert not scope.parts["practice_id"].broadcast
        settings = {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        }
        before = {k: spark.conf.get(k, None) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            selected = scope.select(cur)
            plan = selected._jdf.queryExecution().optimizedPlan().toString()
            of_practices = [x for x in plan.splitlines() if "Join LeftSemi, (practice_id" in x]
            assert "might_contain" in plan and of_practices and not any("strategy=broadcast" in x for x in of_practices)
            assert selected.count() == 50
        finally:
            for k, v in before.items():
                spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


# --- layouts -----------------------------------------------------------------------


@pytest.mark.parametrize("table", TABLE_ORDER)
def test_a_layout_is_proven_by_its_files(spark, table):
    lay = LAYOUTS[table]
    root = scratch_path(spark, "group")
    rows = frame(spark, [row(k % 7 if k % 11 else None, "ABC"[k % 3], f"v{k}", provider_id=str(k % 5), location_id=k % 4, visit_dt=OLD + dt.timedelta(days=k * 37 % 50)) for k in range(400)])
    layout_write(rows, lay, f"{root}/good", num_partitions=4)
    assert tuple(layout_report(spark.read.parquet(f"{root}/good"), lay).first()) == (400, 0, 0)
    rows.repartition(4).write.parquet(f"{root}/shuffled")  # the same rows in any order
    n, descents, overlaps = layout_report(spark.read.parquet(f"{root}/shuffled"), lay).first()
    assert n == 400 and descents > 0 and overlaps > 0
    rows.repartition(4).sortWithinPartitions(*lay.key).write.parquet(f"{root}/sorted")  # sorted files, overlapping ranges
    n, descents, overlaps = layout_report(spark.read.parquet(f"{root}/sorted"), lay).first()
    assert descents == 0 and overlaps > 0
