import random

import numpy as np
import plain

from slicerefresh.llm import decontam as op
from slicerefresh.llm.shared import table


def check(docs, benchmark):
    expected = plain.leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    got = {(r.doc_id, r.item_id): r.similarity for r in op.contaminated(docs, benchmark).collect()}
    assert set(got) == set(expected)
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)
    return expected


def test_matches_plain(spark, medium):
    assert check(medium, table(spark, "/root/testdata/sf0.01", "benchmark"))


def test_changed_and_cut_items(spark):
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(3000)}"
    items = [(k, " ".join(word() for _ in range(rnd.choice((1, 3, 5, 6, 20, 45, 120))))) for k in range(60)] + [(60, None), (61, ""), (62, "a b a b a b a b a b a b")]
    docs = []
    for k in range(150):
        part = (rnd.choice(items)[1] or "").split()
        for _ in range(rnd.randrange(3)):
            if part:
                part[rnd.randrange(len(part))] = word()
        if rnd.random() < 0.3:
            part = part[: rnd.randrange(len(part) + 1)]
        if rnd.random() < 0.2:
            part.insert(len(part) // 2, word())
        docs.append((k, " ".join([word() for _ in range(rnd.randrange(30))] + [x.upper() for x in part] + [word() for _ in range(rnd.randrange(30))])))
    docs += [(200, None), (201, ""), (202, "a b a b a b a b a b a b"), (203, "b a b a")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert len(check(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), benchmark)) > 50


def test_item_blocks_find_the_same(spark, medium, monkeypatch):
    benchmark = table(spark, "/root/testdata/sf0.01", "benchmark")
    whole = {tuple(r) for r in op.contaminated(medium, benchmark).collect()}
    monkeypatch.setattr(op, "ITEM_BYTES", 2000)
    assert len(op.item_blocks(benchmark)) > 3
    assert {tuple(r) for r in op.contaminated(medium, benchmark).collect()} == whole
    leaked = {r[0] for r in whole}
    assert {r.doc_id for r in op.clean(medium, benchmark).collect()} == {r.doc_id for r in medium.collect()} - leaked


def test_index_returns_all_within_the_radius():
    rng = np.random.default_rng(5)
    items = rng.integers(0, 2**63, 40).astype(np.uint64)
    windows = np.concatenate([items, rng.integers(0, 2**63, 60).astype(np.uint64)])
    for k in range(40):  # at all distances up to 40 bits
        flips = rng.choice(64, k, replace=False)
        windows = np.append(windows, items[k] ^ np.uint64(sum(1 << int(f) for f in flips)))
    w, i, d = op.MultiIndex(items).within(windows)
    expected = {(a, b, int(windows[a] ^ items[b]).bit_count()) for a in range(len(windows)) for b in range(40)}
    assert set(zip(w.tolist(), i.tolist(), d.tolist())) == {x for x in expected if x[2] <= op.RADIUS}


def test_similar_bags_lie_within_the_radius():
    """Bags at a similarity of 0.8 and more: the radius misses none of 20,000."""
    rng = np.random.default_rng(6)
    worst = 0
    for _ in range(20_000):
        n = int(rng.integers(9, 60))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = a.copy()
        b[: int(n * 0.11)] = rng.integers(0, 2**63, int(n * 0.11)).astype(np.uint64)
        worst = max(worst, (op.simhash(a) ^ op.simhash(b)).bit_count())
    assert worst <= op.RADIUS


def test_edge_rows(spark, edge, empty):
    benchmark = spark.createDataFrame([(1, "a row that comes twice in all its columns", 1), (2, "ONE", 2), (3, None, 3), (None, "of its own", 4)], "item_id long, text string, doc_id int")
    got = sorted((r.doc_id, r.item_id) for r in op.contaminated(edge, benchmark).collect())
    assert got == [(7, 1), (7, 1), (8, 2), (9, 2)]
    assert op.clean(edge, benchmark).columns == edge.columns and op.clean(edge, benchmark).count() == edge.count() - 4
    assert op.contaminated(empty, benchmark).count() == 0
    nothing = benchmark.filter("false")
    assert op.contaminated(edge, nothing).count() == 0 and op.clean(edge, nothing).count() == edge.count()
