import plain

import corpus_pipeline as p
from slicerefresh.llm.shared import table, written

SF = "/root/testdata/sf0.001"


def test_each_stage_does_its_work(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    benchmark = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert [name for name, _ in p.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontamination", "mixing"]
    for name, stage in p.STAGES:
        before = sorted((r.doc_id, r.text, r.source) for r in docs.collect())
        docs = written(stage(spark, docs, SF), f"test-{name}")
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == (columns if name != "mixing" else [*columns, "copies"])
        if name == "language_id":
            expected = {d for d, text, _ in before if any(c.isalpha() for c in text or "")}
        elif name == "exact_dedup":
            expected = {d for d, (keep, _, _) in plain.dedup([b[:2] for b in before]).items() if d == keep}
        elif name == "jaccard_join":
            expected = {before[k][0] for k, (_, first) in enumerate(plain.jaccard([b[:2] for b in before])) if k == first}
        elif name == "decontamination":
            expected = {b[0] for b in before} - {d for d, _ in plain.leaks([b[:2] for b in before], benchmark)}
        else:
            copies = {b[0]: m[3] for b, m in zip(before, plain.mix([(b[0], b[2], b[1]) for b in before]))}
            expected = {d for d, n in copies.items() if n}
            assert all(after[d].copies == copies[d] for d in after)
        assert set(after) == expected, name
    assert {r.doc_id for r in p.run(spark, SF).collect()} == set(after)


def test_stages_take_odd_documents(spark, edge, empty):
    for frame in (edge, empty):
        docs = frame
        for name, stage in p.STAGES[:-1]:
            docs = written(stage(spark, docs, SF), f"odd-{name}")
            assert docs.columns == frame.columns
        p.mix(spark, docs, SF).count()
