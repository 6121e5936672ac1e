import hashlib

import numpy as np
import plain

from slicerefresh.llm import exact_dedup as op


def test_matches_plain(small):
    got = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in op.exact_dedup(small).collect()}
    assert got == plain.dedup([(r.doc_id, r.text) for r in small.collect()])


def test_edge_rows(edge, empty):
    rows = op.exact_dedup(edge).collect()
    assert len(rows) == edge.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[5].keep_id, by[6].keep_id, by[5].kept, by[6].kept) == (6, 6, False, True)
    assert by[2].keep_id == by[3].keep_id == 3 and by[2].group_size == 3  # null counts as empty; null ids are smallest
    assert by[2].text_sha256 == hashlib.sha256(b"").hexdigest()
    twice = [r for r in rows if r.doc_id == 7]
    assert sorted(r.kept for r in twice) == [False, True] and {r.group_size for r in twice} == {2}
    assert op.exact_dedup(empty).count() == 0


def test_kept_rows_have_their_columns(edge, small, empty):
    kept = op.first_of_each(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 6, 7, 9, 10, 11, 12]
    expected = {k for k, (keep, _, _) in plain.dedup([(r.doc_id, r.text) for r in small.collect()]).items() if k == keep}
    assert {r.doc_id for r in op.first_of_each(small).collect()} == expected
    assert op.first_of_each(empty).count() == 0


def test_fingerprints_compose():
    data = np.random.default_rng(3).integers(0, 256, 3 * op.CHUNK + 17).astype(np.uint8)
    whole = op.fingerprint(data)
    for cut in (0, 1, 1000, op.CHUNK, 2 * op.CHUNK + 5, len(data)):
        assert op.combine(op.fingerprint(data[:cut]), cut, op.fingerprint(data[cut:])) == whole
    for p, value in zip(op.PRIMES, op.fingerprint(data[:50])):
        assert value == sum(int(b) * pow(op.BASE, k, p) for k, b in enumerate(data[:50])) % p


def test_collisions_are_split(spark, monkeypatch):
    """With tiny primes many texts share a fingerprint; the comparison of their bytes still tells them apart."""
    monkeypatch.setattr(op, "PRIMES", (2, 2))
    monkeypatch.setattr(op, "_POW", [op._powers(2)] * 2)
    monkeypatch.setattr(op, "_fingerprints", op.F.arrow_udf(op._FIELDS)(op._fingerprints.func))
    rows = [(k, f"text {k % 10:03d}") for k in range(40)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in op.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain.dedup(rows)
