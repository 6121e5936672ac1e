"""Fill-in-the-middle over frames, against plain string slicing."""

import hashlib
import random
import re

import numpy as np
import pytest
import zstandard
from conftest import EDGE

from slicerefresh.llm import fim

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
compress = zstandard.ZstdCompressor(level=1).compress
decompress = zstandard.ZstdDecompressor().decompress


def plain(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    form = "plain" if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50 else "spm" if h4 % 100 < 80 else "psm"
    out = {"plain": text, "psm": f"<P>{pre}<S>{suf}<M>{mid}", "spm": f"<S>{suf}<P>{pre}<M>{mid}"}[form]
    sizes = (None, None) if form == "plain" else (len(pre), len(mid))
    return (doc_id, len(units), form, *sizes, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def key(row):
    return tuple(str(x) for x in row)


COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


@pytest.mark.parametrize("frame", [7, 64, 1 << 16])
def test_equals_plain_slicing(medium, edge, monkeypatch, frame):
    monkeypatch.setattr(fim, "FRAME", frame)
    docs = edge if frame < 1000 else medium
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] if docs is medium else [e[:2] for e in EDGE]
    if frame == 7:
        docs, rows = docs.filter("length(text) < 1000 or text is null"), [r for r in rows if len(r[1] or "") < 1000]
    got = fim.fill_in_middle(docs).select(*COLUMNS).collect()
    assert sorted(map(key, got)) == sorted(key(plain(*r)) for r in rows)


def test_empty_table(empty):
    assert fim.fill_in_middle(empty).collect() == []


def test_extra_columns_stay(edge):
    out = fim.transform(fim.archive(edge))
    assert set(edge.columns) - {"text"} <= set(out.columns)


def test_markers_stay_plain(spark):
    texts = [f"some words {m} and others" for m in ("<P>", "<S>", "<M>", "<P", "P>")] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    forms = {r.doc_id: r.form for r in fim.fill_in_middle(docs).collect()}
    assert all(forms[k] == "plain" for k, t in enumerate(texts) if re.search("<[PSM]>", t))
    assert {forms[k] for k, t in enumerate(texts) if not re.search("<[PSM]>", t)} == {"plain", "spm", "psm"}


def test_only_cut_frames_are_decompressed(monkeypatch):
    monkeypatch.setattr(fim, "FRAME", 100)
    text = np.frombuffer(b"words of the text " * 1000, np.uint8)
    ends = fim.unit_ends(text)
    frames = fim.frames_of(text, ends, compress)
    read = []

    def counted(data):
        read.append(data)
        return decompress(data)

    out, before, middle = fim.arranged(frames, "spm", 1234, 2345, compress, counted)
    assert len(read) <= 6 and len(frames) > 100
    assert b"".join(map(decompress, out)).startswith(b"<S>")
    assert before == int(ends[1233]) and middle == int(ends[2344] - ends[1233])
    # An output is one zstandard stream, frame after frame.
    assert zstandard.ZstdDecompressor().stream_reader(b"".join(out), read_across_frames=True).read() == b"".join(map(decompress, out))


def test_any_cut_any_frames(monkeypatch):
    rng = random.Random(5)
    pieces = ["a", "bb", " ", "  ", "\n", "é", "漢", "😀", "word<", "P>", " x "]
    for _ in range(1500):
        monkeypatch.setattr(fim, "FRAME", rng.randint(4, 20))
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 40)))
        if re.search("<[PSM]>", text):
            continue
        units = UNITS.findall(text)
        low, high = sorted(rng.randint(0, len(units)) for _ in range(2))
        form = rng.choice(["psm", "spm"])
        data = np.frombuffer(text.encode(), np.uint8)
        out, before, middle = fim.arranged(fim.frames_of(data, fim.unit_ends(data), compress), form, low, high, compress, decompress)
        pre, mid, suf = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
        made = b"".join(map(decompress, out))
        assert made.decode() == (f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}")
        assert (before, middle) == (len(pre), len(mid))
        # The text comes back from the output however it is cut into frames.
        again, at = [], 0
        while at < len(made):
            n = rng.randint(1, 6)
            again.append(compress(made[at : at + n]))
            at += n
        assert b"".join(fim.restored(again, form, decompress)).decode() == text
