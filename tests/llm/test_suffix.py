import hashlib
import random

import numpy as np
import plain

from slicerefresh.llm import suffix as op


def check(df, length=200):
    rows = df.select("doc_id", "text").collect()
    expected = []
    for r, gone in zip(rows, plain.repeats([r.text for r in rows], length)):
        raw = (r.text or "").encode()
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        expected.append((str(r.doc_id), len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    got = op.remove_repeats(df).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(expected)
    for r in got:
        assert sum(s.high - s.low for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans
    return expected


def test_matches_plain(small):
    assert sum(x[2] for x in check(small))


def texts(seed):
    rnd = random.Random(seed)
    noise = lambda n: "".join(rnd.choice("abcdefgh é") for _ in range(n))
    shared = [noise(n) for n in (199, 200, 201, 320, 1500)]
    rows = []
    for k in range(60):
        parts = [noise(rnd.randrange(300))]
        for _ in range(rnd.randrange(4)):
            piece = rnd.choice(shared)
            a = rnd.randrange(len(piece) // 3)
            parts += [piece[a : len(piece) - rnd.randrange(len(piece) // 3)], noise(rnd.randrange(120))]
        rows.append((k, "".join(parts)))
    rows += [(100, "x" * 1000), (101, "x" * 199), (102, "ab" * 300 + noise(50)), (103, noise(400) * 2), (104, shared[4][700:] + shared[4][:700])]
    near = list(noise(3000))
    for k in range(30):
        copy = near[:]
        for _ in range(6):
            copy[rnd.randrange(len(copy))] = "Z"
        rows.append((200 + k, "".join(copy)))
    return rows


def test_cut_and_overlapping_repeats(spark):
    check(spark.createDataFrame(texts(1), "doc_id long, text string").repartition(4))


def test_hot_anchors_and_small_chunks(spark, monkeypatch):
    """Classes of hot anchors are spread by their strings; long texts are read in chunks."""
    monkeypatch.setattr(op, "HOT_PARTS", 10**9)
    monkeypatch.setattr(op, "CHUNK", 700)
    monkeypatch.setattr(op, "BUCKET", 500)
    check(spark.createDataFrame(texts(3), "doc_id long, text string").repartition(3))


def test_edge_rows(edge, empty):
    got = {r.doc_id: r for r in op.remove_repeats(edge).collect()}
    assert got[10].n_removed == got[10].n_bytes and got[11].n_removed == got[10].n_bytes
    assert got[7].n_removed == got[7].n_bytes > 200
    assert got[2].n_bytes == got[3].n_bytes == got[1].n_removed == 0 and got[2].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert op.remove_repeats(empty).count() == 0


def test_every_string_has_an_anchor_that_its_bytes_choose():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    data[1000:2000] = 97
    data[4000:4600] = data[200:800]
    pos, h = op.anchors(data)
    least = op.window_minima(data)
    by = dict(zip(pos.tolist(), h.tolist()))
    for i in range(len(data) - op.LENGTH + 1):
        assert any(by.get(p) == int(least[i]) for p in range(i, i + op.SPAN))


def test_sample_names_order_suffixes(spark):
    """Names of sampled suffixes sort as their first nine symbols."""
    rnd = random.Random(9)
    strings = {k: [rnd.randrange(1, 4) for _ in range(rnd.randrange(1, 40))] for k in range(30)}
    df = spark.createDataFrame([(k, s) for k, s in strings.items()], "sid long, symbols array<long>")
    names = {(r.sid, r.at): r.name for r in op.sample_names(df).collect()}
    assert set(names) == {(k, i) for k, s in strings.items() for i in range(len(s)) if i % 3}
    keys = {(k, i): tuple((strings[k] + [-1] * 9)[i : i + 9]) for k, i in names}
    order = sorted(names, key=names.get)
    for a, b in zip(order, order[1:]):
        assert (names[a] == names[b]) == (keys[a] == keys[b])
    same_residue = [x for x in order if x[1] % 3 == 1]
    assert [keys[x] for x in same_residue] == sorted(keys[x] for x in same_residue)
