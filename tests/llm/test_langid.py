import numpy as np

from slicerefresh.llm import langid as op


def test_held_out_accuracy(medium):
    rows = op.identify(medium).join(medium.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == medium.count() and len(held) > 100
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_filters_return_all_languages():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**32, 3000).astype(np.uint64) for _ in range(70)]  # more than one word of bits
    sets[69] = np.concatenate([sets[69], sets[3][:100]])
    filters = op.LanguageFilters([f"l{k:02d}" for k in range(70)], sets, [1] * 70)
    for lang in (0, 3, 69):
        assert filters.shares(sets[lang], np.zeros(len(sets[lang]), np.int64), 1)[0, lang] == 1.0
    both = filters.shares(sets[3][:100], np.zeros(100, np.int64), 1)[0]
    assert both[3] == both[69] == 1.0
    other = rng.integers(2**40, 2**41, 3000).astype(np.uint64)
    assert filters.shares(other, np.zeros(3000, np.int64), 1).max() < 0.05  # corrected for chance


def test_ngrams_match_plain():
    texts = ["Été à  Paris!!", "", "ab", "Añb cd"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    off = np.cumsum([0, *map(len, raw)])
    gram, row = op.ngrams(data, off)
    for k, text in enumerate(texts):
        folded = "".join(c.lower() if c.isalpha() else " " for c in text)
        while "  " in folded:
            folded = folded.replace("  ", " ")
        b = folded.encode()
        assert [int(x).to_bytes(4, "big") for x in gram[row == k]] == [b[i : i + 4] for i in range(len(b) - 3)]


def test_edge_rows(edge, empty):
    filters = op.fit(edge)
    assert filters.languages == ["en", "fr"]
    rows = {r.doc_id: r for r in op.identify(edge, filters).collect()}
    for doc in (2, 3, 4):
        assert (rows[doc].lang_pred, rows[doc].score, rows[doc].rejected) == ("und", 0.0, True)
    assert rows[12].lang_pred == "fr" and rows[1].lang_pred == "en"
    assert rows[8].lang_pred == "en" and not rows[8].rejected  # too short to be rejected
    kept = op.in_some_language(edge, filters)
    assert kept.columns == edge.columns
    expected = sorted(str(r.doc_id) for r in op.identify(edge, filters).collect() if not r.rejected)
    assert sorted(str(r.doc_id) for r in kept.collect()) == expected and {"1", "5", "12"} <= set(expected)
    assert op.identify(empty).count() == 0
    nothing = op.identify(edge.filter("lang is null")).collect()
    assert all(r.lang_pred == "und" for r in nothing)


def test_only_text_and_fold_matter(medium):
    """Labels of held-out rows change nothing."""
    other = medium.withColumn("lang", op.F.when(op.held_out(op.F.col("doc_id")), "xx").otherwise(op.F.col("lang"))).withColumn("source", op.F.lit("x"))
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in op.identify(d).collect()} for d in (medium, other))
    assert a == b
