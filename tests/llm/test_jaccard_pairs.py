"""A large group of near copies of which most are not linked gives few pairs, and all links."""

import random

import plain

from slicerefresh.llm import jaccard as op


def test_pairs_leave_a_list_only_where_its_token_can_be_the_first_shared(spark, monkeypatch):
    """One to six words of 150 differ: copies with few changes are linked, the others only share words."""
    rnd, met = random.Random(4), []
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(400):
        text = base[:]
        for at in rnd.sample(range(4, 146), rnd.choice((1, 2, 3, 4, 5, 6))):
            text[at] = f"x{k}_{at}"
        rows.append((k, " ".join(text)))
    real = op._possible

    def counted(pairs, share, *more):
        met.append(pairs.count())
        return real(pairs, share, *more)

    monkeypatch.setattr(op, "_possible", counted)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in op.link_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert found == {rows[k][0]: (n, rows[first][0]) for k, (n, first) in enumerate(plain.jaccard(rows))}
    assert met[-1] < 40_000  # 325,000 with a bound that takes all tokens before the shared one for shared
