import plain
import pytest

from slicerefresh.llm import mixing as op


def check(df):
    rows = [(r.doc_id, r.source, r.text) for r in df.collect()]
    expected = sorted(((str(r[0]), str(r[1])), x) for r, x in zip(rows, plain.mix(rows)))
    got = sorted(((str(r.doc_id), str(r.source)), (r["size"], r.source_size, r.target, r.copies)) for r in op.mix(df).collect())
    assert [g[0] for g in got] == [e[0] for e in expected]
    for (key, (size, source_size, target, copies)), (_, (*sizes, goal, times)) in zip(got, expected):
        assert ([size, source_size], copies) == (sizes, times), key
        assert target == pytest.approx(goal)
    return got


def test_matches_plain(medium):
    got = check(medium.select("doc_id", "source", "text"))
    total = sum(g[1][0] for g in got)
    targets = {g[0][1]: g[1][2] for g in got}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    for source, target in targets.items():
        own = [g[1] for g in got if g[0][1] == source]
        largest = max(x[0] for x in own)
        assert abs(sum(x[0] * x[3] for x in own) - target) <= largest / 2 + 1


def test_edge_rows(edge, empty):
    rows = op.mix(edge).collect()
    assert len(rows) == edge.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].taken == by[3].taken == by[2]["size"] == 0
    assert all(0 <= r.copies <= 2 and r.taken == r.copies * r["size"] for r in rows)
    assert op.mix(empty).count() == 0 and op.mixed(empty).count() == 0
    nothing = edge.filter("text is null")
    assert [r.taken for r in op.mix(nothing).collect()] == [0, 0]


def test_mixed_documents(medium, edge):
    taken = {r.doc_id: r.copies for r in op.mix(medium).collect() if r.copies}
    mixed = op.mixed(medium)
    assert mixed.columns == [*medium.columns, "copies"]
    assert {r.doc_id: r.copies for r in mixed.collect()} == taken
    assert op.mixed(edge).columns == [*[c for c in edge.columns if c != "copies"], "copies"]


def test_reruns_agree(medium):
    a, b = (sorted(map(tuple, op.mix(d).collect())) for d in (medium, medium.repartition(7)))
    assert a == b


def test_inclusion_follows_probability(spark):
    """Over many equal documents the longer class gets fewer copies per document, and the sample has its size."""
    df = spark.createDataFrame([(k, "a", "w " * (10 if k % 2 else 1000)) for k in range(4000)], "doc_id long, source string, text string")
    rows = op.mix(df).collect()
    short = [r.copies for r in rows if r["size"] == 10]
    long = [r.copies for r in rows if r["size"] == 1000]
    assert sum(short) / len(short) > sum(long) / len(long) > 1
    assert abs(sum(r.taken for r in rows) - rows[0].target) <= 500
