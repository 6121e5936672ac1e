import random

import plain

from slicerefresh.llm import jaccard as op
from slicerefresh.llm.components import components


def check(df):
    rows = sorted(((r.doc_id, r.text) for r in df.collect()))
    expected = {rows[k][0]: (n, rows[first][0]) for k, (n, first) in enumerate(plain.jaccard(rows))}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op.link_components(df).collect()}
    assert got == expected
    return expected


def near_copies(n_groups, size, seed):
    """Groups of texts of about 80 words that differ in some words, chains of similar ones among them."""
    rnd, rows = random.Random(seed), []
    for group in range(n_groups):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice((7, 40, 90)))]
        for copy in range(size):
            text = base[:]
            for _ in range(rnd.randrange(4)):
                text[rnd.randrange(len(text))] = f"x{group}_{copy}_{rnd.randrange(99)}"
            if rnd.random() < 0.3:
                base = text  # copies of copies drift away from the first
            rows.append((len(rows), " ".join(text)))
    rnd.shuffle(rows)
    return rows


def test_links_between_near_copies_and_a_passage_in_many_documents(spark, medium):
    rnd = random.Random(5)
    rows = near_copies(12, 15, 1)
    passage = " ".join(f"p{k}" for k in range(12))
    rows += [(1000 + k, passage + " " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.choice((0, 1, 2, 30))))) for k in range(150)]
    rows += [(2000 + r.doc_id, r.text) for r in medium.filter("doc_id < 400").collect()]
    expected = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert len({c for _, c in expected.values()}) < len(expected) - 100


def test_edge_rows(edge, empty):
    found = op.link_components(edge).collect()
    rows = {r.doc_id: r for r in found}
    assert len(found) == edge.count()
    assert (rows[2].n_shingles, rows[2].component_id) == (0, 2) and (rows[3].n_shingles, rows[3].component_id) == (0, 3)
    assert rows[5].component_id == rows[6].component_id == 5
    assert rows[8].n_shingles == 1 and rows[9].component_id == 8
    assert rows[10].component_id == rows[11].component_id == 10
    assert rows[7].n_copies == 2 and rows[7].component_id == 7
    assert op.link_components(empty).count() == 0


def test_one_row_of_each_component_stays(edge, small, empty):
    kept = op.one_of_each(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, None, None, 5, 7, 8, 10, 12]))
    rows = sorted((r.doc_id, r.text) for r in small.collect())
    expected = {rows[k][0] for k, (n, first) in enumerate(plain.jaccard(rows)) if k == first}
    assert {r.doc_id for r in op.one_of_each(small).collect()} == expected
    assert op.one_of_each(empty).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(rnd.randrange(100, 400), rnd.randrange(100, 400)) for _ in range(150)] + [(500, k) for k in range(501, 700)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
