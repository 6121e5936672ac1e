"""Benchmark decontamination by SimHash windows and multi-index Hamming search.

Every benchmark item of ``m`` words is sought in the windows of ``m`` words of
every document (a shorter document is one window).  Items and windows have a
64-bit SimHash of their five-word shingles, each weighted by its number of
occurrences.  A multi-index of the items' fingerprints finds all items within
``RADIUS`` bits of a window: the bits are cut in ``BLOCKS`` blocks, and two
fingerprints within the radius differ by at most ``RADIUS // BLOCKS`` bits in
some block (pigeonhole), so each block's table lists the items for every block
value that near.  Candidates are verified by the exact weighted Jaccard
similarity of their shingles, ``sum(min) / sum(max) >= SIMILARITY``.

A window that shares no shingle with any item has similarity 0, so only
windows around a shared shingle get a fingerprint.  At a similarity of 0.8 the
fingerprints differ by 10 bits on average with a deviation of 3; the radius,
the largest with the same tables as 24, lies more than seven deviations above.

The items reach the tasks in blocks of at most ``ITEM_BYTES`` of text: each
block is a bounded broadcast set of queries against all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicerefresh.llm.text import blocks, row_bounds, shingle_hashes, word_hashes, words

WIDTH = 5
SIMILARITY = 0.8
BITS, BLOCKS, RADIUS = 64, 8, 31
ITEM_BYTES = 8 << 20
_FILTER_BITS = 20


def _bits(h: np.ndarray) -> np.ndarray:
    """One row of ``BITS`` votes, +1 or -1, per hash."""
    return np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def _pack(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1, bitorder="little").view("<u8").ravel()


def simhash(shingles: np.ndarray) -> int:
    return int(_pack(_bits(shingles).sum(axis=0, keepdims=True))[0])


def window_simhashes(shingles: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """SimHash of ``count`` shingles from each start."""
    low, high = int(starts[0]), int(starts[-1]) + count
    votes = np.zeros((high - low + 1, BITS), np.int32)
    np.cumsum(_bits(shingles[low:high]), axis=0, out=votes[1:])
    return _pack(votes[starts - low + count] - votes[starts - low])


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two bags of shingles."""
    both, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(at[: len(a)], minlength=len(both)), np.bincount(at[len(a) :], minlength=len(both))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class MultiIndex:
    """Items of one size by the blocks of their fingerprints."""

    def __init__(self, fingerprints: np.ndarray) -> None:
        self.fingerprints = fingerprints
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]) <= RADIUS // BLOCKS
        values = fingerprints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        #: tables[block][value]: marks the items whose block lies near the value.
        self.tables = [near[:, values[:, block]] for block in range(BLOCKS)]

    def within(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs of a window and an item within the radius, and their distances."""
        values = windows.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        marked = np.zeros((len(windows), len(self.fingerprints)), bool)
        for block, table in enumerate(self.tables):
            marked |= table[values[:, block]]
        window, item = np.nonzero(marked)
        distance = np.bitwise_count(windows[window] ^ self.fingerprints[item])
        close = distance <= RADIUS
        return window[close], item[close], distance[close]


def _shingles_of(texts: list[str]) -> list[tuple[int, np.ndarray]]:
    """Words and shingles of each text."""
    out = []
    for i, j, data, off in blocks(pa.array(texts, pa.string())):
        start, end, row = words(data, off)
        h, h_row, _ = shingle_hashes(word_hashes(data, start, end), row, WIDTH, j - i)
        at, n = row_bounds(h_row, j - i), np.bincount(row, minlength=j - i)
        out += [(int(n[k]), h[at[k] : at[k + 1]]) for k in range(j - i)]
    return out


def index_items(items: list[tuple[int, str]]) -> dict:
    """What a task needs to know of a block of items (id, text); items without words are left out."""
    known = [(item, n, h) for (item, _), (n, h) in zip(items, _shingles_of([t or "" for _, t in items]), strict=True) if n]
    sizes: dict[int, dict] = {}
    for item, n, h in known:
        own = sizes.setdefault(n, {"ids": [], "shingles": []})
        own["ids"].append(item)
        own["shingles"].append(h)
    for own in sizes.values():
        own["fingerprints"] = np.array([simhash(h) for h in own["shingles"]], np.uint64)
        own["known"] = np.unique(np.concatenate(own["shingles"]))
    every = np.unique(np.concatenate([own["known"] for own in sizes.values()])) if sizes else np.empty(0, np.uint64)
    maybe = np.zeros(1 << _FILTER_BITS, bool)
    maybe[(every & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
    return {"sizes": sizes, "every": every, "maybe": maybe, "widths": sorted({min(WIDTH, n) for n in sizes})}


def _search(shingles: np.ndarray, n_words: int, own: dict, index: MultiIndex, size: int) -> list[dict]:
    """Best window of a document for each item of one size."""
    length = min(size, n_words)
    count = max(1, length - WIDTH + 1)
    hits = np.flatnonzero(np.isin(shingles, own["known"], assume_unique=False))
    if not len(hits):
        return []
    last = len(shingles) - count
    near = np.zeros(last + 2, np.int32)
    np.add.at(near, np.clip(hits - count + 1, 0, last + 1), 1)
    np.add.at(near, np.clip(hits + 1, 0, last + 1), -1)
    starts = np.flatnonzero(np.cumsum(near[: last + 1]) > 0)
    best: dict[int, tuple] = {}
    for window, k, distance in zip(*(x.tolist() for x in index.within(window_simhashes(shingles, starts, count))), strict=True):
        start = int(starts[window])
        similarity = weighted_jaccard(shingles[start : start + count], own["shingles"][k])
        if similarity >= SIMILARITY and similarity > best.get(k, (0,))[0]:
            best[k] = similarity, start, distance
    return [{"item_id": own["ids"][k], "similarity": s, "start_word": at, "n_words": length, "distance": d} for k, (s, at, d) in sorted(best.items())]


_COLUMNS = "doc_id long, item_id long, similarity double, start_word int, n_words int, distance int"
_TYPES = [("item_id", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("distance", pa.int32())]


class Matcher:
    """A block of items, ready to be sought in Arrow texts."""

    def __init__(self, known: dict) -> None:
        self.known = known
        self.indexes = {size: MultiIndex(own["fingerprints"]) for size, own in known["sizes"].items()}

    def matches(self, text: pa.Array) -> list[list[dict]]:
        """The matches of every text."""
        known = self.known
        out: list[list[dict]] = []
        for i, j, data, off in blocks(text):
            start, end, row = words(data, off)
            word, n_words = word_hashes(data, start, end), np.bincount(row, minlength=j - i)
            found: dict[int, list[dict]] = {}
            for width in known["widths"]:
                h, h_row, _ = shingle_hashes(word, row, width, j - i)
                hit = np.flatnonzero(known["maybe"][(h & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
                hit = hit[np.isin(h[hit], known["every"])]
                at = row_bounds(h_row, j - i)
                for k in np.unique(h_row[hit]).tolist():
                    own_h = h[at[k] : at[k + 1]]
                    seen = np.unique(h[hit[np.searchsorted(hit, at[k]) : np.searchsorted(hit, at[k + 1])]])
                    for size, own in known["sizes"].items():
                        if min(WIDTH, size) == width and np.isin(seen, own["known"]).any():
                            found.setdefault(k, []).extend(_search(own_h, int(n_words[k]), own, self.indexes[size], size))
            out += [found.get(k, []) for k in range(j - i)]
        return out


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[list[tuple[int, str]]]:
    """The items in blocks of about ``ITEM_BYTES`` of text at most."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // ITEM_BYTES)
    place = F.pmod(F.xxhash64("text"), F.lit(max(1, parts)))
    return [[(r["item_id"], r["text"]) for r in items.filter(place == part).collect()] for part in range(parts)]


def _free(spark, items: list[tuple[int, str]]):
    """A column function: whether a text has no match."""
    shared, ready = spark.sparkContext.broadcast(index_items(items)), []

    @F.arrow_udf("boolean")
    def free(text: pa.Array) -> pa.Array:
        if not ready:
            ready.append(Matcher(shared.value))
        return pa.array([not found for found in ready[0].matches(text)], pa.bool_())

    return free


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents in which no item is found, with their columns."""
    for items in item_blocks(benchmark):
        docs = docs.filter(_free(docs.sparkSession, items)(F.col(text_col)))
    return docs


def _search_rows(spark, items: list[tuple[int, str]]):
    """For ``mapInArrow`` over ``doc_id, text``: a row per document and item found in it."""
    shared = spark.sparkContext.broadcast(index_items(items))

    def search(batches):
        matcher = Matcher(shared.value)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found = [(doc, m) for doc, ms in zip(ids, matcher.matches(batch.column("text")), strict=True) for m in ms]
            columns = [pa.array([doc for doc, _ in found], pa.int64())]
            columns += [pa.array([m[name] for _, m in found], kind) for name, kind in _TYPES]
            yield pa.record_batch(columns, names=["doc_id", *[name for name, _ in _TYPES]])

    return search


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row and benchmark item found in it.

    Columns: doc_id, item_id, similarity, start_word, n_words, distance, for
    the most similar window (of equals the first).  Null or empty texts, and
    null or empty items, match nothing.  Repeated rows give their matches each
    time, repeated items each under its id.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = [rows.mapInArrow(_search_rows(docs.sparkSession, items), _COLUMNS) for items in item_blocks(benchmark)]
    out = docs.sparkSession.createDataFrame([], _COLUMNS)
    for part in parts:
        out = out.unionByName(part)
    return out
