"""The registered queries against their SQL, and without a session."""

import subprocess
import sys

import pytest
from oracle_compare import compare

import __spark_entry__ as E
from slicerefresh.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_its_oracle(spark, name):
    assert compare(spark, "/root/testdata/sf0.001", [name], verbose=False)[name][0] == "OK"


def test_all_operators_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op") and x[2].isdigit()}
    assert "pipeline" in names


def test_imports_without_a_session():
    code = "import __spark_entry__ as e; assert 'pipeline' in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=E.__file__.rsplit("/", 1)[0], timeout=100)
