"""Exact deduplication by composable polynomial fingerprints.

A text's bytes ``b`` (A-Z lower-cased) have the fingerprint
``sum(b[i] * B**i) mod p`` for two primes.  It is computed chunk by chunk and
combined by length-shifted arithmetic, ``H(xy) = H(x) + B**len(x) * H(y)``,
so that chunks of one huge text may be hashed apart and in any order.  Texts
of equal length and fingerprint are then compared chunk by chunk: within a
group, the smallest and the largest bytes of each chunk must be the same.
These comparisons are running minima and maxima, combined before the shuffle,
so that a group of any size costs one row per task and chunk.  A group whose
chunks differ (a collision of fingerprints) is split by SHA-256.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicerefresh.llm.shared import join_hot, unique_ids, without, written
from slicerefresh.llm.text import LOWER_ASCII, blocks

#: Two primes below 2**31 (products stay within 64 bits) and the base of the polynomial.
PRIMES = (2147483647, 2147483629)
BASE = 1_000_003
CHUNK = 1 << 16


def _powers(prime: int, n: int = CHUNK) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = pow(BASE, len(out), prime)
        out = np.concatenate([out, out * np.uint64(step) % np.uint64(prime)])
    return out[:n]


_POW = [_powers(p) for p in PRIMES]


def chunk_fingerprint(data: np.ndarray) -> tuple[int, ...]:
    """Fingerprint of at most ``CHUNK`` bytes; zero bytes count, as the length is compared too."""
    wide = data.astype(np.uint64)
    return tuple(int((wide * power[: len(data)] % np.uint64(p)).sum() % np.uint64(p)) for p, power in zip(PRIMES, _POW, strict=True))


def combine(left: tuple[int, ...], left_length: int, right: tuple[int, ...]) -> tuple[int, ...]:
    """Fingerprint of two adjoining pieces from theirs."""
    return tuple((x + pow(BASE, left_length, p) * y) % p for p, x, y in zip(PRIMES, left, right, strict=True))


def fingerprint(data: np.ndarray) -> tuple[int, ...]:
    out = (0,) * len(PRIMES)
    for at in range(0, len(data), CHUNK):
        out = combine(out, at, chunk_fingerprint(data[at : at + CHUNK]))
    return out


_FIELDS = T.StructType().add("n_bytes", "long").add("h1", "long").add("h2", "long").add("sha", "string")


@F.arrow_udf(_FIELDS)
def _fingerprints(text: pa.Array) -> pa.Array:
    size, h1, h2, sha = [], [], [], []
    for _, _, data, off in blocks(text):
        low = LOWER_ASCII[data]
        bounds = off.tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            one = low[a:b]
            x, y = fingerprint(one)
            size.append(b - a)
            h1.append(x)
            h2.append(y)
            sha.append(hashlib.sha256(one).hexdigest())
    return pa.StructArray.from_arrays(
        [pa.array(size, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(sha, pa.string())],
        ["n_bytes", "h1", "h2", "sha"],
    )


KEY = ["n_bytes", "h1", "h2"]


#: Up to so many groups of equal fingerprints are broadcast (about 50 MB); more are joined by a shuffle.
BROADCAST_GROUPS = 500_000


def _collisions(texts: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Keys of groups in which some chunk differs from text to text."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    repeated = groups.filter("group_size > 1")
    members = texts.join(F.broadcast(repeated), KEY) if repeated.count() <= BROADCAST_GROUPS else join_hot(texts, repeated, KEY, "group_size", total)
    chunks = members.select(
        *KEY, F.translate("text", upper, lower).cast("binary").alias("bytes"), F.posexplode(F.sequence(F.lit(0), F.col("n_bytes"), F.lit(CHUNK)))
    ).select(*KEY, "pos", F.substring("bytes", F.col("col").cast("int") + 1, F.lit(CHUNK)).alias("piece"))
    compared = chunks.groupBy(*KEY, "pos").agg(F.min("piece").alias("low"), F.max("piece").alias("high"))
    return written(compared.filter("low <> high").select(KEY).distinct(), "collisions")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_bytes.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  Of equal texts the row with the largest id stays (null ids are
    smallest).  Of rows that share that id too, the first read stays, so that
    exactly one row of each group is kept.  Other columns of the input are not
    read.  An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.select("doc_id", "text", _fingerprints("text").alias("f")).select("doc_id", "text", "f.*")
    rows = written(texts.select("doc_id", *KEY, "sha", F.monotonically_increasing_id().alias("row")), "fingerprints")
    total = rows.count()
    groups = rows.groupBy(*KEY).agg(F.count("*").alias("group_size"))
    collided = _collisions(texts, groups, total)
    by_sha = F.lit("")
    if not collided.isEmpty():
        rows = rows.join(collided.withColumn("collided", F.lit(True)), KEY, "left")
        by_sha = F.when(F.col("collided"), F.col("sha")).otherwise("")
    key = [*KEY, "part"]
    classed = rows.withColumn("part", by_sha)
    kept = classed.groupBy(*key).agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", (-F.col("row")).alias("first"))).alias("top"))
    kept = kept.select(*key, "group_size", F.col("top.doc_id").alias("keep_id"), (-F.col("top.first")).alias("keep_row"))
    return join_hot(classed, kept, key, "group_size", total).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"), "n_bytes"
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that ``exact_dedup`` keeps, with their columns."""
    found = written(exact_dedup(docs, id_col, text_col), "dedup")
    if unique_ids(found):
        return without(docs, found.filter("not kept").select(F.col("doc_id").alias("drop_id")), id_col)
    # Rows share an id: find them by id and text, and keep one of rows that are equal in both.
    kept = found.filter("kept").select(F.col("doc_id").alias("__keep_id"), F.col("text_sha256").alias("__keep_sha"))
    rows = docs.select("*", _fingerprints(F.coalesce(F.col(text_col), F.lit(""))).alias("__f")).select("*", F.col("__f.sha").alias("__sha"))
    same = F.col(id_col).eqNullSafe(F.col("__keep_id")) & (F.col("__sha") == F.col("__keep_sha"))
    return rows.join(kept, same, "left_semi").dropDuplicates([id_col, "__sha"]).select(*docs.columns)
