"""Every registered query against its SQL oracle (DuckDB) on the smallest scale."""

import re

import pytest
from helpers import SMOKE
from oracle_compare import compare

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 4813  # FIXTURES.md, list scope at sf0.001
    assert df.columns == E.queries()["slice_replace_list"](spark, SMOKE).columns


#: The optional operators have tests of their own.
OPTIONAL = re.compile(r"op\d+_|pipeline$")


def test_every_query_matches_its_oracle(spark):
    keys = [k for k in E.queries() if not OPTIONAL.match(k)]
    res = compare(spark, SMOKE, keys, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad
    assert set(keys) <= set(E.oracle_sql())


@pytest.mark.parametrize("key,rows", [("slice_replace_all", 4861), ("distinct_rows", 5082), ("control_char_filter", 5120)])
def test_fixture_counts(spark, key, rows):
    assert E.queries()[key](spark, SMOKE).count() == rows
