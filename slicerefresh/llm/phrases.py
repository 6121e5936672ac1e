"""Collocations: phrases of two to five words whose words come together more often than apart.

Counting follows suffix-tree construction by vertical partitioning.  Every word
of the corpus begins a suffix, cut off after ``DEPTH`` words or at the end of its
piece.  The suffixes are divided by their first words (prefixes): a prefix with
more suffixes than the memory budget allows is made longer by a word, again and
again, and prefixes are then gathered into groups of about one budget.  Each
group is one independent subtree: its suffixes, sorted, with the lengths that
neighbours have in common.  A node is a phrase, and its count is the total of
the leaves below it.  Nodes above a prefix that was made longer lie in several
groups, and their totals are added up.

Three passes read the texts:

* ``word_counts``: all words with their counts, by their bytes.  Words are
  64-bit numbers from here on; this table proves that no number stands for two
  words where it matters, else another seed is taken.
* ``gram_bits``: an upper bound of the count of each pair and triple of words, one
  byte of a fixed-size array each, added up in the shuffle.  A pair or triple
  below the least count ends every suffix; the bound only saves work.
* ``suffixes``: equal suffixes of a task are one row with a count.

Defined results: a null text is empty and a null language ``und``; empty texts
and empty tables give no phrases; repeated rows count each; extra columns are
not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slicerefresh.llm.shared import written
from slicerefresh.llm.text import LOWER_ASCII, blocks, lane_hashes, mix, signed, words

#: Words of the longest phrase.
DEPTH = 5
#: Bytes of text that a task works on at a time.
BLOCK = 1 << 22
#: Suffixes that a subtree holds at about: 48 bytes each, some copies of them while it is sorted.
BUDGET = 1 << 20
#: Longer prefixes at most for one length; beyond it the budget grows.
PREFIXES = 1_000_000
#: Bits of the number of counters of pairs and triples, at least and at most (128 MB in a task, 16 MB broadcast).
PAIR_BITS = (16, 27)
#: Counters of a piece that is added up by itself.
PIECE = 1 << 16

_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)
# --- Fixed values: what ends a piece, and what separates words -----------------
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
# ---------------------------------------------------------------------------
_ENDS = np.zeros(256, bool)
_ENDS[list(PIECE_ENDS)] = True
_SEPARATES = _ENDS.copy()
_SEPARATES[list(BLANKS)] = True
COLUMNS = [f"w{k}" for k in range(1, DEPTH + 1)]


def _texts(batch: pa.RecordBatch, seed: int):
    """Blocks of a batch: lower-cased bytes, starts and ends of words, their numbers, whether the next word goes on."""
    langs = [x if x is not None else "und" for x in batch.column("lang").to_pylist()]
    names = {x: k for k, x in enumerate(dict.fromkeys(langs))}
    coded = np.frombuffer("".join(names).encode(), np.uint8)
    stops = np.cumsum([0, *(len(x.encode()) for x in names)])
    salt = lane_hashes(coded, stops[:-1], stops[1:], seed + 1)
    lang_of = np.array([names[x] for x in langs], np.int64)
    for i, j, data, off in blocks(batch.column("text"), BLOCK):
        low = LOWER_ASCII[data]
        start, end, row = words(low, off, _SEPARATES)
        if not len(start):
            continue
        lang = lang_of[i:j][row]
        h = mix(lane_hashes(low, start, end, seed) ^ salt[lang])
        h[h == 0] = 1  # 0 is no word
        ended = np.cumsum(_ENDS[low])
        goes_on = (row[1:] == row[:-1]) & (ended[start[1:]] == ended[start[:-1]])
        yield low, start, end, h, np.append(goes_on, False), lang, list(names)


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """``h, lang, word, n``: every word of every language with its number and count."""

    def run(batches):
        for batch in batches:
            for low, start, end, h, _, lang, names in _texts(batch, seed):
                other = lane_hashes(low, start, end, seed + 2)  # with h 128 bits: equal within a block
                order = np.argsort(h, kind="stable")
                differs = np.ones(len(h), bool)
                differs[1:] = (h[order][1:] != h[order][:-1]) | (other[order][1:] != other[order][:-1])
                first = np.flatnonzero(differs)
                at = order[first]
                text = [low[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(start[at].tolist(), end[at].tolist())]
                yield pa.record_batch(
                    {
                        "h": pa.array(signed(h[at])),
                        "lang": pa.array([names[k] for k in lang[at].tolist()], pa.string()),
                        "word": pa.array(text, pa.string()),
                        "n": pa.array(np.diff(np.append(first, len(h))), pa.int64()),
                    }
                )

    return docs.mapInArrow(run, "h long, lang string, word string, n long").groupBy("h", "lang", "word").agg(F.sum("n").alias("n"))


def numbered(docs: DataFrame, least: int) -> tuple[DataFrame, int]:
    """The written table of words, and a seed under which no number that is counted stands for two words."""
    seed = 1
    while True:
        counts = written(word_counts(docs, seed), "phrase-words")
        shared = counts.groupBy("h").agg(F.count("*").alias("n_words"), F.sum("n").alias("n"))
        if shared.filter((F.col("n_words") > 1) & (F.col("n") >= least)).isEmpty():
            return counts, seed
        seed += 10


def _grams(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Counters of each word with the next one, and with the next two."""
    pair = mix(h[:-1] * _MUL + h[1:])
    triple = mix(pair[:-1] * _MUL + h[2:])
    return (pair >> _U(64 - bits)).astype(np.int64), (triple >> _U(64 - bits)).astype(np.int64)


def gram_bits(docs: DataFrame, seed: int, least: int, bits: int) -> np.ndarray:
    """One bit per counter: whether the pairs and triples that share it may come ``least`` times.

    Tasks count up to ``least`` (255 at most) and add up the same way.
    """
    top = min(least, 255)
    size = min(PIECE, 1 << bits)

    def count(batches):
        total = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            for _, _, _, h, goes_on, _, _ in _texts(batch, seed):
                pair, triple = _grams(h, bits)
                at, n = np.unique(np.concatenate([pair[goes_on[:-1]], triple[goes_on[:-2] & goes_on[1:-1]]]), return_counts=True)
                total[at] = np.minimum(total[at] + n, top)
        for k in range(0, 1 << bits, size):
            piece = total[k : k + size]
            if piece.any():
                yield pa.record_batch({"piece": pa.array([k // size]), "counts": pa.array([piece.tobytes()])})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                more = np.frombuffer(raw, np.uint8).astype(np.uint16)
                sums[k] = np.minimum(sums.get(k, 0) + more, top)
        for k, s in sums.items():
            yield pa.record_batch({"piece": pa.array([k]), "may": pa.array([np.packbits(s >= top).tobytes()])})

    counted = docs.mapInArrow(count, "piece long, counts binary").repartition((1 << bits) // size, "piece")
    out = np.zeros(((1 << bits) // size, size // 8), np.uint8)
    for r in counted.mapInArrow(add, "piece long, may binary").collect():
        out[r["piece"]] = np.frombuffer(r["may"], np.uint8)
    return out.ravel()


def _combined(w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes (one per column of ``w``) without repetition, and their counts."""
    order = np.lexsort(w[::-1])
    w, n = w[:, order], n[order]
    new = np.ones(w.shape[1], bool)
    new[1:] = (w[:, 1:] != w[:, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    return w[:, first], np.add.reduceat(n, first) if len(first) else n


def _may(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def suffixes(docs: DataFrame, seed: int, may: np.ndarray, bits: int) -> DataFrame:
    """``w1 .. w5, n``: suffixes of two words or more (0: no word) with the count of a task's block."""
    shared = docs.sparkSession.sparkContext.broadcast(may)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            for _, _, _, h, goes_on, _, _ in _texts(batch, seed):
                pair, triple = _grams(h, bits)
                on = goes_on.copy()
                on[:-1] &= _may(shared.value, pair)
                on_two = on.copy()  # the pair and the one behind it, and the triple of both
                on_two[:-2] &= on[1:-1] & _may(shared.value, triple)
                begin = np.flatnonzero(on)
                w = np.zeros((DEPTH, len(begin)), np.uint64)
                w[0], live, reach = h[begin], np.arange(len(begin)), begin
                for d in range(1, DEPTH):
                    w[d, live] = h[reach + 1]
                    further = on_two[reach] & on[reach + 1]
                    live, reach = live[further], reach[further] + 1
                held.append(_combined(w, np.ones(len(begin), np.int64)))
                rows += held[-1][0].shape[1]
                if rows > BUDGET:
                    yield from _batches(held)
                    held, rows = [], 0
        yield from _batches(held)

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in COLUMNS) + ", n long")


def _batches(held: list):
    if held:
        w, n = _combined(np.concatenate([w for w, _ in held], axis=1), np.concatenate([n for _, n in held]))
        for k in range(0, len(n), 1 << 17):
            columns = {c: pa.array(signed(np.ascontiguousarray(x[k : k + (1 << 17)]))) for c, x in zip(COLUMNS, w)}
            yield pa.record_batch({**columns, "n": pa.array(n[k : k + (1 << 17)])})


def grouped(table: DataFrame, budget: int) -> tuple[DataFrame, int]:
    """Suffixes with the length of their prefix and their group, and the number of groups.

    A prefix of ``budget / 8`` suffixes or more is made longer.  There are at
    most ``8 * rows / budget`` such prefixes of a length, so that they can be
    broadcast: the budget is ``rows / PREFIXES`` at least.
    """
    rows = table.count()
    budget = max(budget, 8 * rows // PREFIXES)
    groups = max(1, math.ceil(rows / budget))
    out = table.withColumn("depth", F.lit(1))
    for d in range(1, DEPTH):
        prefix = COLUMNS[:d]
        large = out.filter(F.col("depth") == d).groupBy(*prefix).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") * 8 >= budget)
        large = written(large.select(*prefix, F.lit(True).alias("large")), "phrase-prefixes")
        if large.isEmpty():
            break
        longer = F.when(F.col("large") & (F.col("depth") == d), d + 1).otherwise(F.col("depth"))
        out = out.join(F.broadcast(large), prefix, "left").withColumn("depth", longer).drop("large")
    prefix = [F.when(F.col("depth") > k, F.col(c)).otherwise(F.lit(0)) for k, c in enumerate(COLUMNS)]
    return out.withColumn("group", F.pmod(F.xxhash64(*prefix), F.lit(groups)).cast("int")), groups


def nodes(w: np.ndarray, n: np.ndarray, depth: np.ndarray, least: int):
    """Phrases of one subtree: their words and count; nodes above their prefix with any count."""
    order = np.lexsort(w[::-1])
    w, n, depth = w[:, order], n[order], depth[order]
    # Words that a suffix has in common with the one before.
    common = np.zeros(w.shape[1], np.int64)
    equal = np.ones(w.shape[1] - 1, bool)
    for d in range(DEPTH):
        equal &= w[d, 1:] == w[d, :-1]
        common[1:] += equal
    for d in range(2, DEPTH + 1):
        have = w[d - 1] != 0
        # Suffixes without a d-th word lie between, so the shortest common length counts.
        first = np.flatnonzero((common < d) & have)
        if not len(first):
            break
        total = np.add.reduceat(np.where(have, n, 0), first)
        keep = (total >= least) | (depth[first] > d)
        yield d, w[:, first[keep]], total[keep]


def counts(table: DataFrame, least: int, budget: int = BUDGET) -> DataFrame:
    """``words`` (an array of numbers) and ``a`` of all phrases that come ``least`` times, from their suffixes."""
    dealt, groups = grouped(table, budget)

    def run(batches):
        def tree(parts):
            w = np.concatenate([np.stack([p.column(c).to_numpy() for c in COLUMNS]) for p in parts], axis=1)
            n = np.concatenate([p.column("n").to_numpy() for p in parts])
            depth = np.concatenate([p.column("depth").to_numpy() for p in parts])
            for d, found, total in nodes(w, n, depth, least):
                flat = np.ascontiguousarray(found[:d].T).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, d), pa.int32()), pa.array(flat))
                yield pa.record_batch({"words": lists, "a": pa.array(total)})

        held, group = [], None
        for batch in batches:
            ids = batch.column("group").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for i, j in zip(cuts, cuts[1:]):
                if i < j:
                    if held and ids[i] != group:
                        yield from tree(held)
                        held = []
                    group = ids[i]
                    held.append(batch.slice(i, j - i))
        if held:
            yield from tree(held)

    parts = max(groups, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    trees = dealt.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(run, "words array<long>, a long")
    return trees.groupBy("words").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)


def scored(phrases: DataFrame, vocabulary: DataFrame, sizes: DataFrame) -> DataFrame:
    """Candidates with their language, its size ``n``, and the cut that scores least.

    Every part of a phrase comes at least as often as the phrase, so that its
    count is known.  Counts below 10**18 give exact decimals.
    """
    known = phrases.select(F.col("words").alias("part"), F.col("a").alias("f")).unionByName(
        vocabulary.select(F.array("h").alias("part"), F.col("n").alias("f"))
    )
    whole = vocabulary.select(F.col("h").alias("first"), "lang").join(sizes, "lang")
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cut = cut.withColumns({"left": F.slice("words", 1, F.col("k")), "right": F.expr("slice(words, k + 1, size(words) - k)")})
    cut = cut.join(known.withColumnsRenamed({"part": "left", "f": "l"}), "left").join(known.withColumnsRenamed({"part": "right", "f": "r"}), "right")
    cut = cut.withColumn("first", F.element_at("words", 1)).join(whole, "first")
    big = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    exact = cut.withColumns({"above": F.lit(1000).cast("decimal(4,0)") * (big["a"] * big["n"]).cast("decimal(33,0)"), "below": (big["l"] * big["r"]).cast("decimal(38,0)")})
    score = F.expr("above div below")
    best = exact.groupBy("words", "lang", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("words", "lang", "a", "n", "best.score", "best.l", "best.r")


def uncovered(candidates: DataFrame) -> DataFrame:
    """Candidates without those that a longer candidate holds as often as they come.

    A candidate within a candidate two words longer lies in one that is a word
    longer and comes as often, so one word more decides.
    """
    longer = candidates.filter(F.size("words") > 2).select("words", "a")
    inner = longer.select(F.expr("slice(words, 1, size(words) - 1)").alias("words"), "a").unionByName(
        longer.select(F.expr("slice(words, 2, size(words) - 1)").alias("words"), "a")
    )
    most = inner.groupBy("words").agg(F.max("a").alias("most"))
    return candidates.join(most, "words", "left").filter("most is null or most < a").drop("most")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words_of, seed = numbered(docs, least)
    sizes = written(words_of.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-sizes")
    vocabulary = written(words_of.filter(F.col("n") >= least), "phrase-vocabulary")
    n_words = sizes.agg(F.sum("n")).first()[0] or 0
    bits = min(PAIR_BITS[1], max(PAIR_BITS[0], math.ceil(math.log2(max(2, n_words / 8)))))
    may = gram_bits(docs, seed, least, bits)
    table = written(suffixes(docs, seed, may, bits), "phrase-suffixes")
    found = written(counts(table, least, budget), "phrase-counts")
    kept = written(uncovered(scored(found, vocabulary, sizes)), "phrase-candidates")
    spelled = kept.select("words", F.posexplode("words").alias("at", "h")).join(vocabulary.select("h", "word"), "h")
    spelled = spelled.groupBy("words").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"))
    named = kept.join(spelled, "words").withColumn("phrase", F.array_join(F.col("spelled.word"), " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
