"""Exports describe themselves; what contradicts the description is refused; rejected values are counted."""

import os

import pytest
from helpers import frame, row, uids
from pyspark.sql import types as T

from slicerefresh import PublishError, Scope, SnapshotFormat, sync_from_snapshot, sync_table
from slicerefresh.plans.publish import BucketSpec, publish_table, table_location
from slicerefresh.plans.sync import ORIGINAL_FORMAT, read_snapshot, restore_backup, write_snapshot
from slicerefresh.schema import LAYOUTS
from slicerefresh.session import scratch_path
from slicerefresh.sources.delimited import FormatMismatch, read_delimited, read_manifest, reject_counts, write_delimited

TABLE = "summary_details_by_provider"
LAY = LAYOUTS[TABLE]
ROWS = [row(1, "A", "a", midname="x\x17"), row(1, "B", "b", midname="y\\n~z"), row(2, "A", "c"), row(2, "A", "c")]


def _key(df):
    return sorted(map(repr, df.collect()))


def _refreshed(spark, name):
    root = scratch_path(spark, "man")
    df = frame(spark, ROWS)
    spec = BucketSpec.for_layout(LAY, 4)
    publish_table(df, name, f"{root}/t", spec)
    sync_table(spark, TABLE, current=name, staging=frame(spark, [row(1, "A", "s")]), scope=Scope.of([1], ["A"]), target=name,
               root=f"{root}/t", backup_for=lambda t: f"{root}/backup/{t}", snapshot_for=lambda t: f"{root}/snap/{t}")
    return root, df


def test_a_backup_is_read_back_by_the_snapshot_job(spark):
    root, df = _refreshed(spark, "man_backup")
    stored = read_manifest(spark, f"{root}/backup/{TABLE}")
    assert stored["header"] and stored["columns"] == LAY.columns(True) and stored["rows"] == 4
    assert _key(read_snapshot(spark, f"{root}/backup/{TABLE}", TABLE)) == _key(df)
    sync_from_snapshot(spark, scope=Scope.of([99], ["A"]), snapshot_in_for=lambda t: f"{root}/backup/{t}", staging_for=lambda t: frame(spark, []),
                       target_for=lambda t: "man_again", root_for=lambda t: f"{root}/again", tables=(TABLE,))
    assert uids(spark.table("man_again")) == ["b", "c", "c"]  # the clean rows; nothing was in scope


def test_a_backup_is_put_back_exactly(spark):
    root, df = _refreshed(spark, "man_restore")
    assert uids(spark.table("man_restore")) != uids(df)
    refreshed = table_location(spark, "man_restore")
    restore_backup(spark, TABLE, backup=f"{root}/backup/{TABLE}", target="man_restore", root=f"{root}/t")
    assert _key(spark.table("man_restore").select(*df.columns)) == _key(df)
    assert table_location(spark, "man_restore") != refreshed  # a new version, as always


def test_a_folder_that_does_not_say_its_format_is_not_guessed(spark):
    path = scratch_path(spark, "man")
    write_snapshot(frame(spark, ROWS), path, TABLE, ORIGINAL_FORMAT)
    os.remove(f"{path}/_format.json")
    with pytest.raises(PublishError, match="give its format"):
        read_snapshot(spark, path, TABLE)
    assert read_snapshot(spark, path, TABLE, ORIGINAL_FORMAT).count() == 4
    with pytest.raises(FormatMismatch, match="fields"):  # 27 columns asked of 26
        read_snapshot(spark, path, TABLE, SnapshotFormat(codec="legacy", evolved=True))
    with pytest.raises(FormatMismatch, match="header"):
        read_snapshot(spark, path, TABLE, SnapshotFormat(codec="legacy", header=True))


def test_a_header_is_not_read_as_a_row(spark):
    path = scratch_path(spark, "man")
    write_snapshot(frame(spark, ROWS), path, TABLE, SnapshotFormat(header=True, evolved=True))
    os.remove(f"{path}/_format.json")
    with pytest.raises(FormatMismatch, match="header"):
        read_snapshot(spark, path, TABLE, SnapshotFormat(header=False, evolved=True))


def test_a_manifest_decides_and_contradictions_are_refused(spark):
    path = scratch_path(spark, "man")
    fmt = SnapshotFormat(header=False, evolved=True)
    write_snapshot(frame(spark, ROWS), path, TABLE, fmt)
    with pytest.raises(PublishError, match="was written as"):
        read_snapshot(spark, path, TABLE, ORIGINAL_FORMAT)
    with pytest.raises(PublishError, match="was written as"):
        read_snapshot(spark, path, "summary_details_by_measure")  # other column order
    with pytest.raises(FormatMismatch, match="codec"):
        read_delimited(spark, path, fmt.schema(TABLE), codec="legacy")


def test_a_missing_file_is_noticed(spark):
    path = scratch_path(spark, "man")
    fmt = SnapshotFormat(header=True, evolved=True)
    write_snapshot(frame(spark, ROWS).repartition(3), path, TABLE, fmt)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    os.remove(f"{path}/{parts[0]}")
    with pytest.raises(FormatMismatch, match="were written"):
        read_snapshot(spark, path, TABLE)


def test_row_counts_of_manifests(spark):
    for codec in ("lossless", "legacy"):
        for header in (False, True):
            path = scratch_path(spark, "man")
            write_delimited(frame(spark, ROWS).repartition(3), path, header=header, codec=codec)
            assert read_manifest(spark, path)["rows"] == 4
    empty = scratch_path(spark, "man")
    write_delimited(frame(spark, []), empty, header=True)
    assert read_manifest(spark, empty)["rows"] == 0
    assert read_delimited(spark, empty, frame(spark, []).schema, header=True).count() == 0


def test_rejected_values_are_named(spark):
    path = scratch_path(spark, "man")
    schema = T._parse_datatype_string("i int, s string, ts timestamp_ntz, f float, d date")
    good = '1~x~2024-01-01T00:00:00.000000~1.5~2020-02-29'
    lines = [good, "a~x~2024-01-01T00:00:00.000000~b~2020-02-29", "2~\\N~later~1.5~\\N", "3~only two", good + "~more", '\\N~""~\\N~\\N~2020-02-30']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = read_delimited(spark, path, schema, rejects=True)
    assert [sorted(r["__rejects"]) for r in got.collect()] == [[], ["f", "i"], ["ts"], ["*"], ["*"], ["d"]]
    assert {r.column_name: r.n_rejected for r in reject_counts(got).collect()} == {"f": 1, "i": 1, "ts": 1, "*": 2, "d": 1}
    plain = read_delimited(spark, path, schema)
    assert _key(got.drop("__rejects")) == _key(plain)


def test_rejects_come_from_one_scan(spark):
    path = scratch_path(spark, "man")
    write_snapshot(frame(spark, ROWS), path, TABLE, SnapshotFormat(header=False, evolved=True))
    got = read_delimited(spark, path, SnapshotFormat(evolved=True).schema(TABLE), rejects=True)
    assert reject_counts(got)._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert reject_counts(got).count() == 0


@pytest.mark.parametrize("slices", [None, 16])
def test_a_partitioned_export_replaces_what_was_touched(spark, slices):
    from slicerefresh.plans.incremental import publish_partitioned

    root = scratch_path(spark, "man")
    name, fmt = f"man_parts_{slices or 0}", SnapshotFormat(header=True, evolved=True, partitioned=True)
    rows = [row(p, m, f"{p}{m}", midname="a~b\n\\N") for p in range(6) for m in "AB"] + [row(None, "A", "null")]
    publish_partitioned(frame(spark, rows), name, f"{root}/t", LAY, slices=slices)

    def refresh(staged, practices):
        kw = dict(current=name, staging=frame(spark, staged), scope=Scope.of(practices, ["A"]), target=name, root=f"{root}/t",
                  snapshot_for=lambda t: f"{root}/snap", snapshot_format=fmt)
        sync_table(spark, TABLE, **kw)
        files = {f: os.path.getmtime(f) for d, _, fs in os.walk(f"{root}/snap") for x in fs if x.startswith("part-") for f in [f"{d}/{x}"]}
        back = read_snapshot(spark, f"{root}/snap", TABLE)
        assert _key(back) == _key(spark.table(name).select(*back.columns))
        assert read_manifest(spark, f"{root}/snap")["rows"] == back.count()
        return files

    first = refresh([row(1, "A", "s1")], [1])  # a new folder: all partitions
    second = refresh([row(2, "A", "s2"), row(9, "A", "s9")], [2, 9])
    assert len(first.keys() & second.keys()) >= len(first) - 2  # all others are the same files
    third = refresh([], [9])  # practice 9 goes, and its folder
    # A slice may hold others' rows, which are then exported again.
    assert third.keys() < second.keys() if not slices else len(third) <= len(second)


def test_an_export_of_a_version_that_was_never_published_is_not_built_upon(spark, monkeypatch):
    import slicerefresh.plans.sync as sync_mod
    from slicerefresh.plans.incremental import publish_partitioned

    root = scratch_path(spark, "man")
    fmt = SnapshotFormat(header=False, evolved=True, partitioned=True)
    publish_partitioned(frame(spark, [row(p, "A", f"r{p}") for p in range(5)]), "man_unpublished", f"{root}/t", LAY, slices=16)
    kw = dict(current="man_unpublished", target="man_unpublished", root=f"{root}/t", snapshot_for=lambda t: f"{root}/snap", snapshot_format=fmt)

    def fail(*a):
        raise RuntimeError("injected")

    monkeypatch.setattr(sync_mod, "flip_partitions", fail)
    with pytest.raises(RuntimeError):
        sync_table(spark, TABLE, staging=frame(spark, [row(1, "A", "lost")]), scope=Scope.of([1], ["A"]), **kw)
    monkeypatch.undo()
    sync_table(spark, TABLE, staging=frame(spark, [row(2, "A", "s2")]), scope=Scope.of([2], ["A"]), **kw)
    assert uids(read_snapshot(spark, f"{root}/snap", TABLE)) == uids(spark.table("man_unpublished")) == ["r0", "r1", "r3", "r4", "s2"]
