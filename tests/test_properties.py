"""Properties of slice replacement over generated scopes (fixture at sf0.001)."""

from helpers import SMOKE
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slicerefresh import Scope, control_char_filter, fixtures, slice_delete, slice_replace, slice_select
from slicerefresh.operators.audit import input_counts, sync_audit

MEASURES = ["QPPAF", "QPPAO", "QPPNF", "QPPNO", "QPPRF", "QPPRO"]

practices = st.one_of(st.none(), st.lists(st.integers(0, 12), min_size=1, max_size=5, unique=True))
measures = st.one_of(st.none(), st.lists(st.sampled_from(MEASURES), min_size=1, max_size=3, unique=True))
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def same_multiset(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def in_scope(df, scope):
    flag = "__s"
    return scope.mark(df, flag).filter(F.col(flag)).drop(flag)


@SETTINGS
@given(p=practices, m=measures)
def test_replacement_properties(spark, p, m):
    prod, stg = fixtures.prod(spark, SMOKE), fixtures.staging(spark, SMOKE)
    scope = Scope.of(p, m).resolve(stg, allow_empty=True)
    cur, cstg = control_char_filter(prod), control_char_filter(stg)
    result = slice_replace(prod, stg, scope)

    # Nothing of the slice survives the removal.
    assert in_scope(slice_delete(cur, scope), scope).isEmpty()
    # Inside the slice the result is exactly the cleaned staged slice.
    assert same_multiset(in_scope(result, scope), slice_select(cstg, scope))
    # Outside the slice the result holds the (set of) current rows outside it.
    outside = result.subtract(in_scope(result, scope))
    assert same_multiset(outside.distinct(), slice_delete(cur, scope, dedupe="always"))
    # Applying the same staging twice changes nothing (as a set).
    again = slice_replace(result, stg, scope)
    assert same_multiset(again.distinct(), result.distinct())
    # Audit identities.
    a = sync_audit(cur, cstg, scope, slice_delete(cur, scope)).first()
    assert a["after_add"] == a["after_removal"] + a["to_add"] == result.count()
    unique = cur.distinct()
    c = input_counts(unique, cstg, scope)
    assert slice_delete(unique, scope).count() == c.prod_full - c.to_remove
