import itertools
import random

import numpy as np
import pytest

from slicerefresh.llm import toxicity as op
from slicerefresh.llm.counters import summed

TOXIC = ["grumbolk", "vessnarf", "drottelip", "mokwurst"]


def hide(word, rnd):
    leet = {"o": "0", "e": "3", "s": "5", "a": "@", "i": "1", "l": "1", "t": "7"}
    kind = rnd.randrange(4)
    if kind == 0:
        return "".join(leet.get(c, c) if rnd.random() < 0.8 else c for c in word)
    if kind == 1:
        return " ".join(word)
    if kind == 2:
        k = rnd.randrange(len(word))
        return word[:k] + word[k] * 5 + word[k + 1 :]
    return "-".join(word)


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(8)
    syllables = ["ta", "ren", "mo", "li", "sor", "ke", "pun", "da", "vi", "hol"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 4)))
    docs, labels = [], []
    for k in range(900):
        text = [word() for _ in range(60)]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(2):
                bad = rnd.choice(TOXIC)
                text.insert(rnd.randrange(60), bad if k < 600 else hide(bad, rnd))
        docs.append((k, " ".join(text)))
        labels.append((k, None, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def fitted(corpus):
    docs, labels = corpus
    return op.fit(docs, labels.filter("doc_id < 600"))


def test_plain_and_hidden_words_are_found(corpus, fitted):
    docs, labels = corpus
    rows = op.toxicity(docs, labels, fitted).join(labels, "doc_id").collect()
    assert len(rows) == 900
    plain = [r for r in rows if r.doc_id < 600]
    assert all(r.predicted == r.toxic for r in plain)
    hidden = [r for r in rows if r.doc_id >= 600 and r.toxic]
    assert sum(r.predicted for r in hidden) >= 0.9 * len(hidden)
    assert not any(r.predicted for r in rows if not r.toxic)


def test_restoration(fitted):
    model = fitted["model"]
    for hidden, word in [("gruuuuumbolk", "grumbolk"), ("v3ssn@rf", "vessnarf"), ("d r o t t e l i p", "drottelip"), ("m.o.k.w.u.r.s.t", "mokwurst"), ("m0kwur57", "mokwurst"), ("gr*mbolk", "grumbolk")]:
        assert op.restore(f"ta {hidden} ren", model) == word
    assert op.restore("ta ren moli 12 a b", model) == ""


def best_path(options, model):
    """The best score over all readings of a lattice."""
    best = -1e9
    for path in itertools.product(*options):
        history, score = 0, 0.0
        for letter, cost in (*path, (" ", 0.0)):
            score += cost
            if letter == "" or (letter == " " and history == 0):
                continue
            symbol = 0 if letter == " " else op._symbol_of(letter)
            score += float(model[history, symbol])
            history = ((history << 5) | symbol) & 0x7FFF if symbol else 0
        best = max(best, score)
    return best


def test_viterbi_is_the_best_of_all_readings(fitted):
    model = fitted["model"]
    for span in ("gr0mb0lk", "t4r3n", "m o l 1", "kee3n", "!!ll", "s0 r"):
        options = op.lattice(span)
        text = op.viterbi(options, model)
        readings = [p for p in itertools.product(*options) if " ".join("".join(x for x, _ in p).split()) == " ".join(text.split())]
        assert max(best_path([[x] for x in p], model) for p in readings) == pytest.approx(best_path(options, model), abs=1e-4)


def test_ngram_counts_match_plain(spark):
    texts = ["Abc abé", None, "", "a1b  -- ü"]
    counts = summed(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2), op.count_ngrams, 20)
    sym = lambda c: ord(c) - 96 if "a" <= c <= "z" else int(op._SYMBOL[c.encode()[-1]])
    words = ["abc", "abé", "a", "b", "ü"]
    firsts = {}
    for w in words:
        firsts[sym(w[0])] = firsts.get(sym(w[0]), 0) + 1
    c4 = counts.reshape(32, 32, 32, 32)
    for s, n in firsts.items():
        assert c4[:, :, 0, s].sum() == n  # a word starts after a boundary
    assert c4[0, 1, 2, 3] == 1 and c4[0, 1, 2, sym("é")] == 1


def test_copies_do_not_make_words_toxic(spark):
    """A toxic text that comes many times counts once."""
    docs = [(k, "this harmless sentence is copied " + "with the same words " * 3) for k in range(60)] + [(k, "this other text is clean") for k in range(100, 160)]
    labels = [(k, int(k < 100)) for k, _ in docs]
    fitted = op.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(fitted["feature"]) == 0


def test_edge_rows(spark, edge, empty, fitted):
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = op.toxicity(edge, nothing).collect()
    assert len(rows) == edge.count() and all(r.score == 0 and r.predicted == 0 for r in rows)
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    assert op.toxicity(edge, odd).count() == edge.count()
    assert op.toxicity(edge, nothing, fitted).count() == edge.count()
    assert op.toxicity(empty, nothing).count() == 0


def test_held_out_labels_are_not_used(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", op.F.when(op.held_out(op.F.col("doc_id")), 1 - op.F.col("toxic")).otherwise(op.F.col("toxic")))
    a, b = op.fit(docs, labels), op.fit(docs, flipped)
    assert np.array_equal(a["feature"], b["feature"]) and np.allclose(a["weight"], b["weight"])
