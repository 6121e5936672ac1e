"""Words within their tokens: the vocabulary of LM scoring grows with the corpus."""

import math
from collections import Counter

import numpy as np
import plain
import pytest
from test_lm import plain_score, tokens_of

from slicerefresh.llm import lm as op


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(k, " ".join(f"w{j}" for j in range(1, 2500) if k % j == 0)) for k in range(1, 2500)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def fitted(corpus):
    return op.fit(corpus.select("text"))


def plain_words(text, names, count):
    """The sum of log-probabilities of words within their tokens."""
    space = np.bincount(names, minlength=op.VOCABULARY) / len(names)
    total, distinct = Counter(), Counter()
    for w, n in count.items():
        t = tokens_of(w, names)[0]
        total[t] += n
        distinct[t] += 1
    out = 0.0
    for w in plain.words(text):
        t = tokens_of(w, names)[0]
        spelled = min(1.0, 257.0 ** -(len(w.encode()) + 1) / space[t]) * op.DISCOUNT * (distinct[t] + 1)
        out += math.log((max(count[w] - op.DISCOUNT, 0) + spelled) / (total[t] + op.DISCOUNT))
    return out


@pytest.mark.parametrize("common", [op.COMMON, 40, 0])
def test_words_are_scored_by_their_counts(spark, corpus, fitted, monkeypatch, common):
    monkeypatch.setattr(op, "COMMON", common)
    texts = {1: "w1 w2 w3 w2400 w1999 w1999", 2: "w1 qjxzkvbq w2", 3: "w1 w2311 w2", 4: "", 5: "unseen"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    count = Counter(w for r in corpus.collect() for w in plain.words(r.text))
    counts = op.word_counts(corpus, fitted[0])
    assert {r.n for r in counts.collect()} == set(count.values()) and counts.count() == len(count)
    got = {r.doc_id: r for r in op.pseudo_likelihood(docs, fitted, counts=counts).collect()}
    for k, text in texts.items():
        n, tokens = plain_score(text, *fitted)
        assert got[k].n_tokens == n
        assert got[k].log_likelihood == pytest.approx(tokens + plain_words(text, fitted[0], count), rel=1e-3, abs=1e-2)


def test_a_junk_word_scores_below_a_rare_one_and_the_query_counts_words(spark, corpus, fitted):
    rare = next(f"w{j}" for j in range(1300, 2500) if tokens_of(f"w{j}", fitted[0])[0] >= op.VOCABULARY - op.RARE)
    own = tokens_of(rare, fitted[0])
    junk = next(w for w in (f"zq{k}xj" for k in range(10**4)) if tokens_of(w, fitted[0]) == own)
    docs = spark.createDataFrame([(1, f"w1 {rare} w2"), (2, f"w1 {junk} w2")], "doc_id long, text string")
    got = {r.doc_id: r.log_likelihood for r in op.pseudo_likelihood(docs, fitted, counts=op.word_counts(corpus, fitted[0])).collect()}
    assert got[2] < got[1] - 3
    words, tokens = ({r.doc_id: r.log_likelihood for r in op.pseudo_likelihood(corpus, f).collect()} for f in (None, fitted))
    assert sum(words.values()) < sum(tokens.values()) - 1000
