"""Hidden words in spans of any length."""

import time

import numpy as np
import pyarrow as pa
import pytest
from test_toxicity import corpus, fitted  # noqa: F401

from slicerefresh.llm import toxicity as op
from slicerefresh.llm.text import blocks


def restored(text, model):
    (_, _, data, off), *_ = blocks(pa.array([text]))
    assert op.suspicious_rows(data, off).all()
    return op.restore(text, model)


LONG = {
    " ".join("grumbolkvessnarfdrottelipmokwurstgrumbolk"): "mokwurst",
    "gr" + 70 * "u" + "mbolk": "grumbolk",
    "-".join(["gr0mbolk", "v3ssn@rf"] * 5): "v",
    "-".join(["grumbolk", "gr0mbolk", "grumb0lk"] * 4): "grumbolk",
    "$".join(["mokwurst"] * 9): "mokwurst",
}


@pytest.mark.parametrize("span", LONG)
def test_long_spans_are_decoded(fitted, span):  # noqa: F811
    assert len(span) > op.LONGEST
    assert LONG[span] in restored(f"ta {span} ren", fitted["model"])


def test_a_text_of_one_long_hidden_word_is_toxic(spark, fitted):  # noqa: F811
    docs = spark.createDataFrame([(1, "ta ren gr" + 70 * "u" + "mbolk moli"), (2, "ta ren gr" + 70 * "a" + "n moli")], "doc_id long, text string")
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.predicted for r in op.toxicity(docs, nothing, fitted).collect()} == {1: 1, 2: 0}


def test_readings_of_long_spans_take_linear_time(fitted):  # noqa: F811
    span = "gr0mbolk-" * 5_000
    assert len(op.restore(span, fitted["model"])) > 20_000 and np.isfinite(fitted["model"]).all()


def test_long_runs_of_stars_are_boundaries():
    model = op.language_model(np.ones(1 << 20, np.int64))
    start = time.perf_counter()
    assert op.viterbi(op.lattice("ab" + "*" * 100_000 + "cd"), model) == "ab cd"
    assert time.perf_counter() - start < 5


def test_features_that_chance_explains_are_not_kept():
    n = np.array([3.0, 3.0, 30.0, 40.0])
    toxic = np.array([3.0, 1.0, 30.0, 4.0])
    chance = op.log_chance(toxic, n, 0.1)
    assert chance[0] == pytest.approx(3 * np.log(0.1)) and chance[2] == pytest.approx(30 * np.log(0.1))
    assert chance[3] == 0 and chance[0] < chance[1] < 0
    assert (op.log_chance(toxic, n, 0.0) == 0).all() and (op.log_chance(toxic, n, 1.0) == 0).all()
