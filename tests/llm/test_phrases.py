"""Phrases against plain counting, with budgets of any size."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import EDGE

from slicerefresh.llm import phrases
from slicerefresh.llm.text import lane_hashes


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, least, top):
    f, size = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(ws)
            for i in range(len(ws)):
                for d in range(1, min(5, len(ws) - i) + 1):
                    f[lang][tuple(ws[i : i + d])] += 1
    out = []
    for lang, count in f.items():
        known = {p: a for p, a in count.items() if a >= least}
        longer = defaultdict(int)
        for p, a in known.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        longer[p[i:j]] = max(longer[p[i:j]], a)
        rows_of = []
        for p, a in known.items():
            if len(p) > 1 and longer[p] < a:
                score, k = min((1000 * a * size[lang] // (known[p[:k]] * known[p[k:]]), k) for k in range(1, len(p)))
                rows_of.append((-score, -a, " ".join(p).encode(), known[p[:k]], known[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, size[lang], -score))
    return sorted(out)


def got(df, **kw):
    return sorted(tuple(r) for r in phrases.collocations(df, **kw).collect())


@pytest.fixture(scope="module")
def prose():
    """Few words, long repetitions, ends of pieces and blanks of all kinds."""
    rng = random.Random(11)
    words = ["The", "the", "of", "a", "été", "x", "new", "york", "city", "漢字", "don't"]
    rows = []
    for k in range(150):
        body = []
        for _ in range(rng.randint(0, 60)):
            body.append(rng.choice(words) if rng.random() < 0.7 else "New York city hall")
            body.append(rng.choice([" ", "  ", "\t", ". ", ",", "\n", " ! ", "  "]) if rng.random() < 0.4 else " ")
        rows.append((rng.choice(["en", "fr", None, ""]), "".join(body)))
    return rows + [("en", "same passage in many texts " * 4)] * 40 + [("de", None), ("de", "")]


@pytest.mark.parametrize("budget", [1 << 20, 16, 200])
def test_equals_plain_counting(spark, prose, budget):
    docs = spark.createDataFrame(prose, "lang string, text string").repartition(5)
    assert got(docs, least=5, top=40, budget=budget) == plain(prose, 5, 40)


def test_equals_plain_counting_of_documents(small):
    rows = [(r.lang, r.text) for r in small.collect()]
    assert got(small, least=10, top=500) == plain(rows, 10, 500)


def test_odd_rows(edge, empty):
    assert got(edge, least=3) == plain([(e[2], e[1]) for e in EDGE], 3, 2000)
    assert got(empty) == []


def test_numbers_that_stand_for_two_words_are_refused(spark, prose, monkeypatch):
    seeds = []

    def weak(data, start, end, seed=0):
        seeds.append(seed)
        h = lane_hashes(data, start, end, seed)
        return h % np.uint64(4) if seed == 1 else h  # under the first seed most words share a number

    monkeypatch.setattr(phrases, "lane_hashes", weak)
    docs = spark.createDataFrame(prose, "lang string, text string").coalesce(1)
    assert phrases.numbered(docs.selectExpr("coalesce(lang, 'und') as lang", "text"), 5)[1] > 1


def test_exact_products(spark):
    """1000 * a * n passes 64 bits."""
    big = 900_000_000_000_000
    found = spark.createDataFrame([([1, 2], big)], "words array<long>, a long")
    words = spark.createDataFrame([(1, "en", "x", big + 7), (2, "en", "y", big + 9)], "h long, lang string, word string, n long")
    sizes = spark.createDataFrame([("en", 10**18 - 1)], "lang string, n long")
    row = phrases.scored(found, words, sizes).first()
    assert row.score == 1000 * big * (10**18 - 1) // ((big + 7) * (big + 9))


def test_lane_hashes_of_strings_that_other_hashes_confuse():
    a = "a"
    b = "b"
    for _ in range(10):
        a, b = a + b, b + a  # Thue-Morse words: equal under any polynomial modulo 2**64
    strings = [a, b, "x" + a, a + "x", "", "x", "x\0", "\0", "\0\0", "12345678", "123456780", "1234567"]
    data = np.frombuffer("".join(strings).encode(), np.uint8)
    ends = np.cumsum([len(s) for s in strings])
    h = lane_hashes(data, ends - [len(s) for s in strings], ends)
    assert len(set(h.tolist())) == len(strings)
    alone = [lane_hashes(np.frombuffer(s.encode(), np.uint8), np.array([0]), np.array([len(s)]))[0] for s in strings]
    assert alone == h.tolist()
