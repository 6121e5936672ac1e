"""Physical plans: broadcast only counted scopes, no cartesian product,
no shuffle of the kept rows of a bucketed table, filters reach the scan."""

from helpers import frame, row

from slicerefresh import Scope
from slicerefresh.operators.scope import ResolvedScope
from slicerefresh.plans.publish import BucketSpec, publish_table
from slicerefresh.plans.sync import replacement_plan
from slicerefresh.schema import LAYOUTS
from slicerefresh.session import scratch_path

SPEC = BucketSpec.for_layout(LAYOUTS["summary_details_by_practice"], 4)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark):
    root = scratch_path(spark, "plans")
    cur = frame(spark, [row(i % 5, "AB"[i % 2], f"c{i}") for i in range(40)])
    publish_table(cur.repartition(4, *SPEC.columns), "plan_cur", f"{root}/cur", SPEC)
    publish_table(frame(spark, [row(1, "A", "s1"), row(2, "B", "s2")]), "plan_stg", f"{root}/stg")
    return spark.table("plan_cur"), spark.table("plan_stg")


def test_all_scope_is_broadcast_and_kept_rows_do_not_shuffle(spark):
    cur, stg = _tables(spark)
    scope = Scope.of(None, None).resolve(stg, max_literal_values=0)
    r = replacement_plan(cur, stg, scope, bucket_spec=SPEC, current_bucketed=True)
    p = plan(r.result)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert p.count("BroadcastHashJoin") == 4  # two marker joins (kept), two semi joins (added)
    # One exchange only: the staged slice into buckets.
    assert "Exchange hashpartitioning" not in plan(r.kept) and "Rebalance" not in plan(r.kept)
    assert "Bucketed: true" in p or "bucketed" in p.lower()


def test_scope_over_the_limit_is_not_broadcast(spark):
    cur, stg = _tables(spark)
    scope = Scope.of(None, None).resolve(stg, max_broadcast_keys=1, max_literal_values=0)
    assert not scope.parts["practice_id"].broadcast and scope.parts["measure_id"].broadcast is False
    df = scope.mark(cur, "f")
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert "BROADCAST" not in p


def test_small_all_scope_becomes_a_pushed_down_list(spark):
    cur, stg = _tables(spark)
    scope = Scope.of(None, None).resolve(stg)
    assert scope.parts["practice_id"].literal and sorted(scope.parts["practice_id"].values) == [1, 2]
    p = plan(scope.select(cur))
    assert "In(practice_id, [1,2])" in p and "BroadcastHashJoin" not in p


def test_literal_scope_reaches_the_scan(spark):
    cur, _ = _tables(spark)
    scope = Scope.of([1, 2], ["A"]).resolve()
    p = plan(scope.select(cur))
    assert "In(practice_id, [1,2])" in p
    assert isinstance(scope, ResolvedScope)


def test_key_operators_aggregate_map_side(spark):
    from slicerefresh import key_check, key_collapse

    cur, _ = _tables(spark)
    key = LAYOUTS["summary_details_by_practice"].key
    for df in (key_collapse(cur, key), key_check(cur, key)):
        p = plan(df)
        assert "Window" not in p and "SortMergeJoin" not in p
        assert "partial_" in p  # a partial aggregate runs in every map task before the shuffle


def test_sql_surface_binds_values_and_pushes_them_down(spark):
    from slicerefresh import register_views, slice_sql

    cur, stg = _tables(spark)
    view, _ = register_views(cur, stg, "plan_surface")
    df = slice_sql(spark, view, Scope.of([1, 2], ["A"]).resolve())
    assert "In(practice_id, [1,2])" in plan(df)
    assert sorted(r["practice_id"] for r in df.collect()) == sorted(r["practice_id"] for r in Scope.of([1, 2], ["A"]).resolve().select(cur).collect())


def test_key_collapse_on_a_bucketed_table_does_not_shuffle_it(spark):
    cur, stg = _tables(spark)
    scope = Scope.of([1], ["A"]).resolve()
    r = replacement_plan(cur, stg, scope, bucket_spec=SPEC, current_bucketed=True, collapse_keys=SPEC.columns)
    assert "partial_max" in plan(r.kept) and "Exchange" not in plan(r.kept)
