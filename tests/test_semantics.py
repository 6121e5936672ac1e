"""Slice replacement semantics on tiny frames."""

import pytest
from pyspark.sql import functions as F
from helpers import frame, row, uids

from slicerefresh import Scope, control_char_filter, slice_delete, slice_replace, slice_select
from slicerefresh.operators.audit import input_counts, sync_audit
from slicerefresh.schema import CANONICAL, conform, table_schema

LIST = Scope.of([1], ["A"])


def test_null_keys_are_kept_and_never_added(spark):
    cur = frame(spark, [row(None, "A", "c1"), row(1, None, "c2"), row(1, "A", "c3")])
    stg = frame(spark, [row(None, "A", "s1"), row(1, "A", "s2")])
    out = slice_replace(cur, stg, LIST.resolve())
    assert uids(out) == ["c1", "c2", "s2"]


def test_duplicates_survive_when_nothing_is_removed(spark):
    cur = frame(spark, [row(2, "A", "d"), row(2, "A", "d")])
    stg = frame(spark, [])
    kept = slice_delete(cur, LIST.resolve())
    assert uids(kept) == ["d", "d"]


def test_duplicates_collapse_when_the_slice_is_not_empty(spark):
    cur = frame(spark, [row(2, "A", "d"), row(2, "A", "d"), row(1, "A", "x")])
    assert uids(slice_delete(cur, LIST.resolve())) == ["d"]
    assert uids(slice_delete(cur, LIST.resolve(), dedupe="never")) == ["d", "d"]
    assert uids(slice_delete(frame(spark, [row(2, "A", "d")] * 2), LIST.resolve(), dedupe="always")) == ["d"]


def test_added_rows_are_not_deduplicated(spark):
    cur = frame(spark, [row(1, "A", "x")])
    stg = frame(spark, [row(1, "A", "n"), row(1, "A", "n")])
    assert uids(slice_replace(cur, stg, LIST.resolve())) == ["n", "n"]


def test_control_character_in_each_input(spark):
    cur = frame(spark, [row(2, "A", "c_dirty", midname="a\x17b"), row(2, "A", "c_null", midname=None),
                        row(2, "A", "c_empty", midname="")])
    stg = frame(spark, [row(1, "A", "s_dirty", midname="m\x17"), row(1, "A", "s_ok")])
    out = slice_replace(cur, stg, LIST.resolve())
    assert uids(out) == ["c_empty", "c_null", "s_ok"]
    assert uids(control_char_filter(cur)) == ["c_empty", "c_null"]


def test_scope_is_a_cross_product_not_pairs(spark):
    # staging has (1,A) and (2,B) only; (1,B) in current is still in scope.
    cur = frame(spark, [row(1, "B", "c1b"), row(3, "A", "c3a")])
    stg = frame(spark, [row(1, "A", "s1a"), row(2, "B", "s2b")])
    out = slice_replace(cur, stg, Scope.of(None, None).resolve(stg))
    assert uids(out) == ["c3a", "s1a", "s2b"]


def test_delete_without_add_and_add_without_delete(spark):
    cur = frame(spark, [row(1, "A", "c1"), row(2, "A", "c2")])
    empty = frame(spark, [])
    assert uids(slice_replace(cur, empty, LIST.resolve())) == ["c2"]
    stg = frame(spark, [row(1, "A", "s1")])
    assert uids(slice_replace(frame(spark, [row(2, "A", "c2")]), stg, LIST.resolve())) == ["c2", "s1"]


def test_staging_in_other_order_and_without_evolved_column(spark):
    cur = frame(spark, [row(2, "A", "c2")])
    stg = frame(spark, [row(1, "A", "s1")])
    shuffled = stg.drop("datasource").select(*reversed([c for c in CANONICAL if c != "datasource"]))
    out = slice_replace(cur, shuffled, LIST.resolve())
    assert out.columns == CANONICAL
    assert uids(out) == ["c2", "s1"]
    assert out.filter("visit_uid = 's1'").first()["datasource"] is None


def test_conform_casts_text_and_lenient_nulls(spark):
    df = spark.createDataFrame([("7", "2020-01-02 03:04:05.000006", "x1")], "practice_id string, visit_dt string, location_id string")
    out = conform(df).select("practice_id", "visit_dt").first()
    assert out["practice_id"] == 7 and out["visit_dt"].microsecond == 6
    with pytest.raises(Exception):
        conform(df).select("location_id").collect()
    assert conform(df, lenient=True).first()["location_id"] is None


def test_empty_scope_raises_unless_allowed(spark):
    stg = frame(spark, [])
    with pytest.raises(ValueError):
        Scope.of(None, ["A"]).resolve(stg)
    Scope.of(None, ["A"]).resolve(stg, allow_empty=True)
    with pytest.raises(ValueError):
        Scope.of([], ["A"]).resolve()


def test_unknown_table_name():
    with pytest.raises(ValueError):
        table_schema("summary_details_by_nothing")
    assert len(table_schema("summary_details_by_location").fields) == 26


def test_parse_command_line_scope():
    s = Scope.parse("3,6, 7", "NA")
    assert s.values == {"practice_id": [3, 6, 7], "measure_id": None}
    # Both forms of the measure list: bare (production job) and already quoted (snapshot job).
    assert Scope.parse("NA", "QPP238_2,QPP130").values["measure_id"] == ["QPP238_2", "QPP130"]
    assert Scope.parse("NA", "'QPP238_2','QPP130'").values["measure_id"] == ["QPP238_2", "QPP130"]


def test_large_literal_lists_become_frames(spark):
    cur = frame(spark, [row(i, "A", f"c{i}") for i in range(5)])
    scope = Scope.of(list(range(0, 3000, 2)), ["A"]).resolve(max_literal_values=100)
    assert not scope.parts["practice_id"].literal
    assert uids(slice_select(cur, scope)) == ["c0", "c2", "c4"]


def test_audit_counts(spark):
    cur = frame(spark, [row(1, "A", "x"), row(2, "A", "d"), row(2, "A", "d"), row(None, "A", "n")])
    stg = frame(spark, [row(1, "A", "s1"), row(1, "A", "s2"), row(3, "A", "s3")])
    scope = LIST.resolve()
    c = input_counts(cur, stg, scope)
    assert (c.prod_full, c.to_remove, c.to_add) == (4, 1, 2)
    a = sync_audit(cur, stg, scope, slice_delete(cur, scope)).first().asDict()
    assert a == {"prod_full": 4, "to_remove": 1, "to_add": 2, "after_removal": 2, "after_add": 4}


def test_key_check_reports_duplicates_and_optionally_null_keys(spark):
    from slicerefresh import key_check

    cur = frame(spark, [row(1, "A", "d"), row(1, "A", "d"), row(None, "A", "n"), row(2, "A", "u")])
    key = ("practice_id", "measure_id", "visit_dt", "unit", "visit_uid")
    assert [r["visit_uid"] for r in key_check(cur, key).collect()] == ["d"]
    assert sorted(r["visit_uid"] for r in key_check(cur, key, null_keys=True).collect()) == ["d", "n"]


def test_status_update_takes_a_null_high_water_for_a_matched_practice(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from slicerefresh import practice_high_water, refresh_status

    t0, t1 = dt.datetime(2001, 1, 1), dt.datetime(2031, 1, 1)
    result = frame(spark, [row(1, "A", "x", visit_dt=None), row(2, "A", "y")])
    status = spark.createDataFrame([(1, t0, t0), (2, t0, t0)], "practiceid int, enddate timestamp_ntz, lastrefreshtime timestamp_ntz")
    out = refresh_status(status, practice_high_water(result), F.lit("2031-01-01 00:00:00").cast("timestamp_ntz"))
    got = {r["practiceid"]: (r["enddate"], r["lastrefreshtime"]) for r in out.collect()}
    assert got[1] == (None, t1)  # UPDATE sets the max even when it is null
    assert got[2][1] == t1


def test_evolve_schema_is_idempotent_and_conform_drops_extras(spark):
    from slicerefresh import evolve_schema

    df = frame(spark, [row(1, "A", "x")]).drop("datasource").withColumn("extra", F.lit(1))
    once = evolve_schema(df)
    assert "datasource" in once.columns and evolve_schema(once).columns == once.columns
    assert conform(once).columns == CANONICAL


def test_audit_identity_and_missing_scope_source_are_refused():
    from slicerefresh.operators.audit import AuditCounts

    with pytest.raises(AssertionError):
        AuditCounts(10, 2, 3, after_removal=8, after_add=12).check()
    AuditCounts(10, 2, 3, after_removal=8, after_add=11).check()
    with pytest.raises(ValueError):
        Scope.of(None, ["A"]).resolve()  # everything in staging, but no staging given


def test_scope_from_a_dataframe_and_sql_surface_with_a_distributed_scope(spark):
    from slicerefresh import register_views, slice_sql

    cur = frame(spark, [row(1, "A", "a1"), row(2, "A", "a2"), row(3, "B", "b3"), row(None, "A", "n")])
    practices = spark.createDataFrame([(1,), (3,), (None,)], "practice_id int")
    scope = Scope.of(practices, None).resolve(frame(spark, [row(9, "A", "s"), row(9, "B", "t")]), max_literal_values=0)
    assert not scope.parts["practice_id"].literal and scope.size("practice_id") == 2  # nulls never count
    assert uids(slice_select(cur, scope)) == ["a1", "b3"]
    view, _ = register_views(cur, cur, "surface_frames")
    assert uids(slice_sql(spark, view, scope)) == ["a1", "b3"]
