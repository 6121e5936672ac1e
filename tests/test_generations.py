"""Readers never see a half-done switch; a generation of unknown state is rebuilt; tables by slices."""

import threading

import pytest
from helpers import frame, row, uids
from pyspark.sql import functions as F

from slicerefresh import Scope, prune_versions, slice_replace, sync_all
from slicerefresh.plans import generations as gen
from slicerefresh.plans.incremental import (
    DISTINCT_PROPERTY,
    adopt,
    publish_partitioned,
    stage_incremental,
    switch_partitions,
    sync_incremental,
    table_properties,
    undo_partitions,
)
from slicerefresh.plans.publish import PublishError
from slicerefresh.schema import CANONICAL, LAYOUTS, TABLE_ORDER
from slicerefresh.session import scratch_path

LAY = LAYOUTS["summary_details_by_practice"]
PROVIDER = LAYOUTS["summary_details_by_provider"]


def _files(spark, table):
    return {r[0] for r in spark.table(gen.physical(spark, table)).select("_metadata.file_path").distinct().collect()}


def _refresh(spark, name, root, staged, scope, lay=LAY):
    return sync_incremental(spark, name, staging=frame(spark, staged), scope=scope.resolve(), root=root, layout=lay)


@pytest.mark.parametrize("slices", [None, 8])
def test_a_reader_never_misses_a_practice(spark, slices):
    root = scratch_path(spark, "gen")
    name = f"gen_reader_{slices or 0}"
    practices, last = list(range(6)), 20 if slices else 6
    publish_partitioned(frame(spark, [row(p, "A", f"v0-{p}") for p in practices]), name, root, LAY, slices=slices)
    wrong, seen, stop = [], set(), threading.Event()

    def read():
        while not stop.is_set():
            rows = spark.table(name).select("practice_id", "visit_uid").collect()
            versions = {r.visit_uid.split("-")[0] for r in rows}
            # One row per practice, all of them of one version.
            if sorted(r.practice_id for r in rows) != practices or len(versions) != 1:
                wrong.append(sorted(tuple(r) for r in rows))
            seen.update(versions)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(1, last + 1):
            _refresh(spark, name, root, [row(p, "A", f"v{k}-{p}") for p in practices], Scope.of(practices, ["A"]))
    finally:
        stop.set()
        reader.join()
    assert not wrong
    assert len(seen) > 2  # the reader did read while versions changed
    assert uids(spark.table(name)) == sorted(f"v{last}-{p}" for p in practices)


def test_generations_take_turns_and_catch_up(spark):
    root = scratch_path(spark, "gen")
    publish_partitioned(frame(spark, [row(p, "A", f"r{p}") for p in range(4)]), "gen_turns", root, LAY)
    names = [gen.active_generation(spark, "gen_turns")]
    for p in (0, 1, 2, 0):
        _refresh(spark, "gen_turns", root, [row(p, "A", f"s{p}")], Scope.of([p], ["A"]))
        names.append(gen.active_generation(spark, "gen_turns"))
    assert [n[-1] for n in names] == list("ababa")
    assert uids(spark.table("gen_turns")) == ["r3", "s0", "s1", "s2"]


def test_a_generation_of_unknown_state_is_rebuilt(spark):
    root = scratch_path(spark, "gen")
    publish_partitioned(frame(spark, [row(p, "A", f"r{p}") for p in range(4)] + [row(None, "A", "null")]), "gen_lost", root, LAY)
    _refresh(spark, "gen_lost", root, [row(1, "A", "s1")], Scope.of([1, 2], ["A"]))  # practice 2 goes
    idle = gen.other_generation(gen.active_generation(spark, "gen_lost"))
    gen.set_properties(spark, idle, {gen.VERSION_PROPERTY: ""})  # as a job leaves it that ended while it was made ready
    gen.drop_partitions(spark, idle, "practice_id", [0, 3])
    _refresh(spark, "gen_lost", root, [row(3, "A", "s3")], Scope.of([3], ["A"]))
    assert uids(spark.table("gen_lost")) == ["null", "r0", "s1", "s3"]


def test_a_lost_generation_and_pruned_versions(spark):
    root = scratch_path(spark, "gen")
    publish_partitioned(frame(spark, [row(p, "A", f"r{p}") for p in range(3)]), "gen_gone", root, LAY)
    for k in range(3):
        _refresh(spark, "gen_gone", root, [row(p, "A", f"s{k}{p}") for p in range(3)], Scope.of([0, 1, 2], ["A"]))
    assert len(prune_versions(spark, "gen_gone", root, keep=0)) >= 2
    spark.sql(f"DROP TABLE {gen.other_generation(gen.active_generation(spark, 'gen_gone'))}")
    _refresh(spark, "gen_gone", root, [row(1, "A", "t1")], Scope.of([1], ["A"]))
    assert uids(spark.table("gen_gone")) == ["s20", "s22", "t1"]


def test_undo_gives_readers_the_version_before(spark):
    root = scratch_path(spark, "gen")
    publish_partitioned(frame(spark, [row(1, "A", "r1"), row(2, "A", "r2")]), "gen_undo", root, LAY)
    staged = stage_incremental(spark, "gen_undo", staging=frame(spark, [row(1, "A", "s1")]), scope=Scope.of([1], ["A"]).resolve(), root=root, layout=LAY)
    sw = switch_partitions(spark, staged)
    assert uids(spark.table("gen_undo")) == ["r2", "s1"]
    undo_partitions(spark, sw)
    assert uids(spark.table("gen_undo")) == ["r1", "r2"]
    _refresh(spark, "gen_undo", root, [row(2, "A", "s2")], Scope.of([2], ["A"]))
    assert uids(spark.table("gen_undo")) == ["r1", "s2"]


def test_new_columns_come_with_the_switch(spark):
    root = scratch_path(spark, "gen")
    old = frame(spark, [row(1, "A", "r1"), row(2, "A", "r2")]).drop("datasource")
    publish_partitioned(old, "gen_evolve", root, LAY, schema=old.schema)
    assert "datasource" not in spark.table("gen_evolve").columns
    for k in (4, 5):
        _refresh(spark, "gen_evolve", root, [row(1, "A", f"s{k}", datasource=k)], Scope.of([1], ["A"]))
        assert sorted((r.visit_uid, r.datasource) for r in spark.table("gen_evolve").collect()) == [("r2", None), (f"s{k}", k)]


def test_a_partitioned_table_is_adopted(spark):
    root = scratch_path(spark, "gen")
    frame(spark, [row(1, "A", "r1"), row(2, "A", "r2")]).write.partitionBy("practice_id").option("path", f"{root}/t").saveAsTable("gen_adopt")
    gen.set_properties(spark, "gen_adopt", {"slicerefresh.clean": "midname:23", DISTINCT_PROPERTY: "true"})
    adopt(spark, "gen_adopt")
    for k in range(2):
        _refresh(spark, "gen_adopt", root, [row(1, "A", f"s{k}")], Scope.of([1], ["A"]))
    assert uids(spark.table("gen_adopt")) == ["r2", "s1"]


# --- tables by slices ----------------------------------------------------------------


def test_untouched_slices_stay_in_place(spark):
    """A list scope on the by-provider layout, whose key begins with the provider."""
    root = scratch_path(spark, "gen")
    rows = [row(p, m, f"{p}{m}{k}", provider_id=f"d{k}") for p in range(8) for m in "ABC" for k in range(3)]
    publish_partitioned(frame(spark, rows), "sl_place", root, PROVIDER, slices=64)
    before = _files(spark, "sl_place")
    staged = [row(3, "B", "new", provider_id="d9"), row(50, "A", "other")]
    scope = Scope.of([3, 4, 50], ["B"])
    run = sync_incremental(spark, "sl_place", staging=frame(spark, staged), scope=scope.resolve(), root=root, layout=PROVIDER)
    after = _files(spark, "sl_place")
    assert len(run.touched) == 2  # (3, B) and (4, B); nothing of 50 is in scope
    assert len(before & after) >= len(before) - 2 * 3 and before - after
    full = slice_replace(frame(spark, rows), frame(spark, staged), scope.resolve())
    assert uids(spark.table("sl_place")) == uids(full)
    assert spark.table("sl_place").columns == [c for c in CANONICAL]


def test_slices_with_duplicates_are_all_rewritten_when_the_original_removes_duplicates(spark):
    root = scratch_path(spark, "gen")
    rows = [row(1, "A", "a"), row(2, "A", "twice"), row(2, "A", "twice"), row(None, "B", "n"), row(None, "B", "n")]
    publish_partitioned(frame(spark, rows), "sl_dups", root, PROVIDER, slices=16)
    assert table_properties(spark, "sl_dups")[DISTINCT_PROPERTY] == "false"
    stg = [row(1, "A", "s"), row(1, "A", "s")]
    run = _refresh(spark, "sl_dups", root, stg, Scope.of([1], ["A"]), PROVIDER)
    assert uids(spark.table("sl_dups")) == ["n", "s", "s", "twice"]
    assert (run.audit.prod_full, run.audit.to_remove, run.audit.after_add) == (5, 1, 4)
    assert table_properties(spark, "sl_dups")[DISTINCT_PROPERTY] == "false"  # staged rows came twice
    _refresh(spark, "sl_dups", root, [row(1, "A", "t")], Scope.of([1], ["A"]), PROVIDER)
    assert table_properties(spark, "sl_dups")[DISTINCT_PROPERTY] == "true"
    assert uids(spark.table("sl_dups")) == ["n", "t", "twice"]


def test_a_slice_that_is_emptied_goes(spark):
    root = scratch_path(spark, "gen")
    publish_partitioned(frame(spark, [row(1, "A", "a"), row(2, "B", "b")]), "sl_empty", root, LAY, slices=64)
    n = len(gen.partition_names(spark, "sl_empty"))
    _refresh(spark, "sl_empty", root, [], Scope.of([1], ["A"]))
    assert uids(spark.table("sl_empty")) == ["b"] and len(gen.partition_names(spark, "sl_empty")) == n - 1


def test_a_new_target_by_slices_is_undone_with_its_group(spark, monkeypatch):
    import slicerefresh.plans.sync as sync_mod

    root = scratch_path(spark, "gen")
    targets = {t: f"sl_new_{t.rsplit('_', 1)[-1]}" for t in TABLE_ORDER}
    kw = dict(scope=Scope.of([1], ["A"]), current_for=lambda t: frame(spark, [row(1, "A", "c"), row(2, "A", "d"), row(2, "A", "d")]),
              staging_for=lambda t: frame(spark, [row(1, "A", "s")]), target_for=lambda t: targets[t], root_for=lambda t: f"{root}/{t}", slices=8)
    real, calls = sync_mod.flip_partitions, []

    def flaky(spark_, sw):
        calls.append(sw)
        if len(calls) == 3:
            raise RuntimeError("injected")
        real(spark_, sw)

    monkeypatch.setattr(sync_mod, "flip_partitions", flaky)
    with pytest.raises(RuntimeError, match="injected"):
        sync_all(spark, **kw)
    monkeypatch.undo()
    assert not any(spark.catalog.tableExists(n) for n in targets.values())
    report = sync_all(spark, **kw)
    assert all(uids(spark.table(n)) == ["d", "s"] for n in targets.values())
    assert [(r.audit.prod_full, r.audit.after_removal, r.audit.after_add) for r in report.runs] == [(3, 1, 2)] * 4
    # From then on only the touched slices are rewritten.
    before = {n: _files(spark, n) for n in targets.values()}
    sync_all(spark, **{**kw, "current_for": lambda t: targets[t], "staging_for": lambda t: frame(spark, [row(2, "A", "e")]), "scope": Scope.of([2], ["A"])})
    for n in targets.values():
        assert uids(spark.table(n)) == ["e", "s"] and before[n] & _files(spark, n)


def test_a_file_that_is_missing_or_foreign_is_noticed(spark, monkeypatch):
    """The written files are counted, whatever the tasks reported."""
    from slicerefresh.operators.audit import WrittenMismatch
    from slicerefresh.plans import incremental

    root = scratch_path(spark, "gen")
    publish_partitioned(frame(spark, [row(1, "A", "a"), row(2, "A", "b")]), "sl_wrong", root, LAY, slices=8)
    real = incremental._write_partitioned

    def less(df, *args):
        real(df.where(F.col("visit_uid") != "s2"), *args)

    monkeypatch.setattr(incremental, "_write_partitioned", less)
    with pytest.raises(WrittenMismatch):
        _refresh(spark, "sl_wrong", root, [row(1, "A", "s1"), row(1, "A", "s2")], Scope.of([1], ["A"]))
    monkeypatch.undo()
    assert uids(spark.table("sl_wrong")) == ["a", "b"]


def test_prepared_over_another_version_is_refused(spark):
    root = scratch_path(spark, "gen")
    publish_partitioned(frame(spark, [row(1, "A", "a")]), "gen_race", root, LAY)
    staged = stage_incremental(spark, "gen_race", staging=frame(spark, [row(1, "A", "s")]), scope=Scope.of([1], ["A"]).resolve(), root=root, layout=LAY)
    _refresh(spark, "gen_race", root, [row(1, "A", "t")], Scope.of([1], ["A"]))
    with pytest.raises(PublishError, match="stage it again"):
        switch_partitions(spark, staged)
    assert uids(spark.table("gen_race")) == ["t"]
