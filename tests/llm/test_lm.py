import math

import numpy as np
import plain
import pytest

from slicerefresh.llm import lm as op
from slicerefresh.llm.text import word_hashes


def tokens_of(text, names):
    out = []
    for w in plain.words(text):
        data = np.frombuffer(w.encode(), np.uint8)
        h = word_hashes(data, np.array([0]), np.array([len(data)]))
        out.append(int(names[int(h[0]) >> (64 - op.SKETCH_BITS)]))
    return out


def plain_score(text, names, flat):
    """The sum of log-probabilities, one token at a time."""
    net, token, total = op.Network(flat), tokens_of(text, names), 0.0
    for i, t in enumerate(token):
        hidden = net.bias.astype(float).copy()
        for k, d in enumerate([d for d in range(-op.SIDE, op.SIDE + 1) if d]):
            hidden += net.embed[k][token[i + d] if 0 <= i + d < len(token) else op._PAD]
        hidden = np.tanh(hidden)
        a = hidden @ net.cls + net.cls_bias
        b = hidden @ net.word[t // op.WITHIN] + net.word_bias[t // op.WITHIN]
        total += a[t // op.WITHIN] - math.log(np.exp(a).sum()) + b[t % op.WITHIN] - math.log(np.exp(b).sum())
    return len(token), total


@pytest.fixture(scope="module")
def fitted(medium):
    return op.fit(medium.select("text"))


def test_matches_plain(small, fitted):
    texts = {r.doc_id: r.text for r in small.collect()}
    for r in op.pseudo_likelihood(small, fitted).collect():
        if len(texts[r.doc_id]) < 2000:
            n, total = plain_score(texts[r.doc_id], *fitted)
            assert r.n_tokens == n and r.log_likelihood == pytest.approx(total, rel=1e-3, abs=1e-2)


def mean(df):
    row = df.agg({"log_likelihood": "sum", "n_tokens": "sum"}).first()
    return row[0] / row[1]


def test_learned_from_both_sides(medium, fitted):
    """The network beats its start, and the frequencies of tokens alone."""
    trained = mean(op.pseudo_likelihood(medium, fitted))
    start = mean(op.pseudo_likelihood(medium, (fitted[0], op.Network().flat)))
    every = np.concatenate([tokens_of(r.text, fitted[0]) for r in medium.limit(200).collect()])
    p = np.bincount(every, minlength=op.VOCABULARY) / len(every)
    alone = float((p[p > 0] * np.log(p[p > 0])).sum())
    assert trained > start + 0.5 and trained > alone - 0.4


def test_gradients():
    rng = np.random.default_rng(2)
    context, token = rng.integers(0, op.VOCABULARY + 1, (50, 2 * op.SIDE)), rng.integers(0, op.VOCABULARY, 50)
    net = op.Network()
    net.flat[:] = rng.normal(0, 0.3, len(net.flat))
    before = op.Network(net.flat.copy())
    moment = np.zeros_like(net.flat)
    net.learn(context, token, moment)
    step = np.flatnonzero(moment)
    for at in rng.choice(step, 12, replace=False):
        up, down = (op.Network(before.flat.copy()) for _ in range(2))
        up.flat[at] += 1e-2
        down.flat[at] -= 1e-2
        slope = (up.log_probability(context, token).mean() - down.log_probability(context, token).mean()) / 2e-2
        assert abs(abs(slope) - math.sqrt(moment[at])) < 2e-3
        if abs(slope) > 2e-3:
            assert np.sign(net.flat[at] - before.flat[at]) == np.sign(slope)


def test_vocabulary_counts_the_corpus(spark):
    rows = [("the cat sat " * 3,), ("The dog",), (None,), ("",)]
    names = op.vocabulary(spark.createDataFrame(rows, "text string").repartition(2))
    assert tokens_of("the", names) == [0]  # the most frequent word, whatever its case


def test_edge_rows(edge, empty):
    rows = {r.doc_id: r for r in op.pseudo_likelihood(edge).collect()}
    assert rows[2].n_tokens == rows[3].n_tokens == 0 and rows[2].log_likelihood == 0 and rows[2].per_token is None
    assert rows[10].n_tokens == 60_000 and rows[10].log_likelihood < 0
    assert op.pseudo_likelihood(edge).count() == edge.count()
    assert op.pseudo_likelihood(empty).count() == 0
