"""The pipeline's near-duplicate stage against a plain join of five-word sets at 0.8."""

import corpus_pipeline
import plain
from pyspark.sql import functions as F


def kept(rows, width, percent):
    """Ids of the first row of each component; rows in the order of their ids."""
    sets = [frozenset(plain.shingles(plain.words(text), width)) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = {}
    for k, own in enumerate(sets):
        for o in {o for s in own for o in lists.get(s, ())}:
            if 100 * len(own & sets[o]) >= percent * len(own | sets[o]):
                a, b = sorted((find(k), find(o)))
                parent[b] = a
        for s in own:
            lists.setdefault(s, []).append(k)
    return {rows[k][0] for k in range(len(rows)) if find(k) == k}


def changed(base, n):
    """A text of distinct words with ``n`` of its last words replaced: 60 - n of 60 + n five-word shingles are shared."""
    return " ".join(base[: len(base) - n] + [f"new{n}_{k}" for k in range(n)])


def test_stage_joins_five_words_at_four_fifths(spark, medium):
    rows = []
    for group in range(20):
        base = [f"g{group}w{k}" for k in range(64)]
        rows += [(10_000 + 10 * group + n, changed(base, n)) for n in (0, 3 + group % 6)]
    copies = [(r.doc_id, r.text) for r in medium.filter("doc_id < 300").collect()]
    rows = sorted(rows + copies)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("a")).repartition(3)
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert got == kept(rows, 5, 80)
    assert got != kept(rows, 4, 85)
