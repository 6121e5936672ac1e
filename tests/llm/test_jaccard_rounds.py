"""Large groups of near copies are joined in rounds; words that weak hashes confuse stay apart."""

import random

import plain

from slicerefresh.llm import decontam
from slicerefresh.llm import jaccard as op


def thue_morse(n):
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


def check(df):
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    expected = {rows[k][0]: (n, rows[first][0]) for k, (n, first) in enumerate(plain.jaccard(rows))}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op.link_components(df).collect()} == expected
    return expected


def test_thue_morse_words_are_different_words(spark):
    x, y = thue_morse(1024)
    texts = [x, y, f"{x} {y} one two", f"{y} {x} one two", f"{x} q w e r", f"{y} q w e r"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in op.link_components(docs).collect()} == {k: k for k in range(6)}
    leaks = spark.createDataFrame([(1, f"{y} u v w x y"), (2, f"{x} u v w x y")], "doc_id long, text string")
    items = spark.createDataFrame([(1, f"{x} u v w x y")], "item_id long, text string")
    assert {r.doc_id for r in decontam.contaminated(leaks, items).collect()} == {2}


def test_a_large_group_is_joined_before_pairs_are_emitted(spark, monkeypatch):
    """Most copies are not like the first hub; chains of copies of copies join them all the same."""
    rnd, rows, emitted = random.Random(9), [], []
    base = [f"w{k}" for k in range(120)]
    heads = [base]
    for k in range(600):
        text = list(rnd.choice(heads[-20:]))
        for _ in range(rnd.randrange(1, 3)):
            text[rnd.randrange(len(text))] = f"x{k}_{rnd.randrange(99)}"
        heads.append(text)
        rows.append((k, " ".join(text)))
    passage = " ".join(f"p{k}" for k in range(30))
    rows += [(1000 + k, f"{passage} {' '.join(f'u{rnd.randrange(10**6)}' for _ in range(rnd.choice((1, 5, 40))))}") for k in range(200)]
    real = op._cross_pairs

    def counted(entries, share):
        pairs = real(entries, share)
        emitted.append(pairs.count())
        return pairs

    monkeypatch.setattr(op, "_cross_pairs", counted)
    expected = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert len({c for d, (_, c) in expected.items() if d < 1000}) < 30
    assert emitted[0] < 20_000  # of 180,000 pairs of copies and 20,000 that share the passage
