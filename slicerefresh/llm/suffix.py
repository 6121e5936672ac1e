"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else is removed.  The work follows the repeats, not the bytes:

1. *Parse.*  Of every ``LENGTH`` bytes, the ``GRAM``-byte string with the smallest
   hash is an anchor (the choice depends on these bytes only, so equal strings
   choose the same).  Equal texts are one class.  Only the surroundings of
   anchors that occur more than once can hold a repeat; these regions, cut at
   such anchors, are strings of phrases (symbols: 64-bit hashes).
2. *Sort sampled triples.*  Phrase positions 1 and 2 modulo 3 are the sample;
   their triples of symbols are sorted across the cluster and named by rank.
3. *Recurse on names.*  The names of each residue are strings again; their
   triples are sorted and named, ``LEVELS`` times in all, so that a name stands
   for the order of the first ``3**LEVELS`` phrases of the suffix.
4. *Merge remaining suffixes.*  Positions 0 modulo 3 are ordered by their first
   symbol (or two) and the name of the sampled suffix after it: one sorted list
   with residue 1, one with residue 2, beside the list of the sample.
5. *Compare adjacent prefixes.*  Neighbours in a list whose pieces (the phrase and
   the ``LENGTH - 1`` bytes after it) are equal prove that all strings that start
   in the phrase repeat.  Of equal pieces one goes on for all.
6. What this leaves open, strings that straddle the end of a repeat, is decided
   exactly: each remaining string of ``LENGTH`` bytes is compared by its 64-bit hash
   with those that have the same anchor.  They travel in packed arrays; classes
   of hot anchors are spread by the strings' own hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicerefresh.llm.shared import HOT_PARTS, join_hot, written
from slicerefresh.llm.text import blocks, list_array, mix, prefix_hash, range_hash, signed

LENGTH, GRAM = 200, 32
#: GRAM-byte strings that start within LENGTH bytes.
SPAN = LENGTH - GRAM + 1
LEVELS = 2
#: Windows of a text that are looked at together (bounds the memory for a long text).
CHUNK = 1 << 20
#: Strings per packed bucket, about.
BUCKET = 1 << 20
#: Up to so many texts are fetched by a broadcast of their ids; more by a shuffle.
BROADCAST_IDS = 200_000
_END = -(1 << 63)
_NONE = np.empty(0, np.uint64)


# --- anchors ---------------------------------------------------------------------------------


def _sliding(h: np.ndarray, reduce, fill: int) -> np.ndarray:
    """``reduce`` over every ``SPAN`` consecutive values."""
    m = len(h)
    wide = np.concatenate([h, np.full(-m % SPAN, fill, np.uint64)]).reshape(-1, SPAN)
    before = reduce.accumulate(wide, axis=1).ravel()
    after = reduce.accumulate(wide[:, ::-1], axis=1)[:, ::-1].ravel()
    return reduce(after[: m - SPAN + 1], before[SPAN - 1 : m])


def _grams(data: np.ndarray) -> np.ndarray:
    prefix = prefix_hash(data)
    start = np.arange(len(data) - GRAM + 1)
    return range_hash(prefix, start, start + GRAM)


def window_minima(data: np.ndarray) -> np.ndarray:
    """The hash of the anchor of each string of ``LENGTH`` bytes."""
    if len(data) < LENGTH:
        return _NONE
    return _sliding(_grams(data), np.minimum, 2**64 - 1)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of a text; all equal minima of a string are anchors."""
    found, hashes = [np.empty(0, np.int64)], [_NONE]
    for at in range(0, len(data) - LENGTH + 1, CHUNK):
        h = _grams(data[at : at + CHUNK + LENGTH - 1])
        least = _sliding(h, np.minimum, 2**64 - 1)
        around = np.concatenate([np.zeros(SPAN - 1, np.uint64), least, np.zeros(SPAN - 1, np.uint64)])
        chosen = np.flatnonzero(h == _sliding(around, np.maximum, 0))
        found.append(at + chosen)
        hashes.append(h[chosen])
    pos, first = np.unique(np.concatenate(found), return_index=True)
    return pos, np.concatenate(hashes)[first]


@F.arrow_udf(T.StructType().add("n_bytes", "long").add("sha", "string").add("pos", T.ArrayType(T.IntegerType())).add("h", T.ArrayType(T.LongType())))
def _scan(text: pa.Array) -> pa.Array:
    sizes, shas, pos, hashes = [], [], [], []
    for _, _, data, off in blocks(text):
        bounds = off.tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            p, h = anchors(data[a:b])
            sizes.append(b - a)
            shas.append(hashlib.sha256(data[a:b]).hexdigest())
            pos.append(p)
            hashes.append(h)
    at = np.concatenate([[0], np.cumsum([len(p) for p in pos])])
    flat_pos = np.concatenate(pos).astype(np.int32) if pos else np.empty(0, np.int32)
    flat_hash = np.concatenate(hashes) if hashes else _NONE
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), list_array(at, pa.array(flat_pos)), list_array(at, pa.array(signed(flat_hash)))],
        ["n_bytes", "sha", "pos", "h"],
    )


# --- phrases ---------------------------------------------------------------------------------


def phrases(data: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phrases of a text's regions around the given anchors.

    Returns per phrase: region, first byte, number of strings of ``LENGTH`` bytes
    that start in it (within the region), symbol, and hash of its piece.
    """
    low, high = np.maximum(0, pos - SPAN + 1), np.minimum(len(data), pos + LENGTH)
    opens = np.concatenate([[True], low[1:] > np.maximum.accumulate(high)[:-1]])
    region = np.cumsum(opens) - 1
    first = np.flatnonzero(opens)
    start, end = low[first], np.maximum.reduceat(high, first)
    # A region's first phrase begins at its start, further ones at its anchors.
    cuts = np.unique(np.concatenate([start, pos]))
    of = np.searchsorted(start, cuts, "right") - 1
    nxt = np.concatenate([cuts[1:], [len(data)]])
    stop = np.minimum(nxt, end[of])
    n_starts = np.maximum(0, np.minimum(stop, end[of] - LENGTH + 1) - cuts)
    prefix = prefix_hash(data)
    symbol = range_hash(prefix, cuts, stop)
    piece = range_hash(prefix, cuts, np.minimum(stop + LENGTH - 1, end[of]))
    return of, cuts, n_starts, symbol, piece


_PHRASES = "cid long, region int, starts array<int>, counts array<int>, symbols array<long>, pieces array<long>"


def _phrase_rows(batches):
    for batch in batches:
        cids, positions = batch.column("cid").to_pylist(), batch.column("pos")
        for i, j, data, off in blocks(batch.column("text")):
            out: dict[str, list] = {c.split()[0]: [] for c in _PHRASES.split(", ")}
            for k in range(i, j):
                own = data[off[k - i] : off[k - i + 1]]
                of, cuts, n, symbol, piece = phrases(own, np.sort(np.asarray(positions[k].values)).astype(np.int64))
                for r in range(int(of[-1]) + 1):
                    part = slice(*np.searchsorted(of, [r, r + 1]))
                    for name, value in zip(out, (cids[k], r, cuts[part].astype(np.int32), n[part].astype(np.int32), signed(symbol[part]), signed(piece[part])), strict=True):
                        out[name].append(value)
            types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))


# --- difference-cover sort of phrase strings ---------------------------------------------------


def _triples(strings: DataFrame, *more: str) -> DataFrame:
    """Every position of ``strings(sid, symbols, ...)``: sid, at, t1, t2, t3 and ``more`` arrays' elements."""
    shifted = [F.col("symbols").alias("t1"), F.slice("symbols", 2, F.size("symbols")).alias("t2"), F.slice("symbols", 3, F.size("symbols")).alias("t3")]
    zipped = strings.select("sid", *shifted, *more).select("sid", F.posexplode(F.arrays_zip("t1", "t2", "t3", *more)).alias("at", "z"))
    t = [F.coalesce(F.col(f"z.{c}"), F.lit(_END)).alias(c) for c in ("t1", "t2", "t3")]
    return zipped.select("sid", "at", *t, *[F.col(f"z.{c}").alias(c) for c in more])


def _named(triples: DataFrame, tag: str) -> DataFrame:
    """Names of triples, in their order: the sorted distinct triples are numbered along the range partitions."""
    keys = ["t1", "t2", "t3"]
    distinct = triples.select(keys).distinct().repartitionByRange(*keys).sortWithinPartitions(*keys)
    names = written(distinct.withColumn("name", F.monotonically_increasing_id()), tag)
    return triples.join(names, keys).drop(*keys)


def sample_names(strings: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Names of the sampled suffixes of ``strings(sid, symbols)``: sid, at, name.

    Names are ordered as the suffixes' first ``3**levels`` symbols.
    """
    sample = _triples(strings).filter("at % 3 <> 0")
    named = _named(sample, "sa-names")
    for level in range(1, levels):
        residue = named.select("sid", (F.col("at") % 3).alias("residue"), F.struct("at", "name").alias("x"))
        again = residue.groupBy("sid", "residue").agg(F.array_sort(F.collect_list("x")).alias("x"))
        again = again.select(F.struct("sid", "residue").alias("sid"), F.transform("x", lambda x: x["name"]).alias("symbols"))
        named = _named(_triples(again), f"sa-names-{level}")
        named = named.select("sid.sid", (F.col("at") * 3 + F.col("sid.residue")).alias("at"), "name")
    return named


def _neighbours(batches):
    """Of each run of equal pieces in sorted order: all are repeated, the first goes on."""
    names, kept, follows = ("k1", "k2", "k3", "piece", "sid", "at"), None, False
    for batch in batches:
        rows = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in names], 1)
        if not len(rows):
            continue
        # The last row of the batch before stands in front, to be compared and to be told as a first.
        rows = rows if kept is None else np.concatenate([kept, rows])
        same = np.zeros(len(rows) + 1, bool)
        same[1:-1] = (rows[1:, :4] == rows[:-1, :4]).all(axis=1)
        same[0] = follows
        first = ~same[:-1] & same[1:]
        later = same[:-1].copy()
        later[0] &= kept is None
        out = np.flatnonzero(first | later)
        yield pa.record_batch([pa.array(rows[out, 4]), pa.array(rows[out, 5].astype(np.int32)), pa.array(first[out])], names=["sid", "at", "first"])
        kept, follows = rows[-1:], bool(same[-2])


def repeated_phrases(strings: DataFrame) -> DataFrame:
    """Phrases whose piece occurs again, by the suffix sort of ``strings(sid, symbols, pieces)``: sid, at, first."""
    names = written(sample_names(strings), "sa-sample")
    every = _triples(strings, "pieces").select("sid", "at", "t1", "t2", F.col("pieces").alias("piece"))
    after = [names.select("sid", (F.col("at") - k).alias("at"), F.col("name").alias(f"r{k}")) for k in range(3)]
    ranked = every
    for k in range(3):
        ranked = ranked.join(after[k], ["sid", "at"], "left")
    ranked = written(ranked.select("sid", "at", "t1", "t2", "piece", *[F.coalesce(f"r{k}", F.lit(-1)).alias(f"r{k}") for k in range(3)]), "sa-ranked")
    none = F.lit(0).cast("long")
    lists = {
        "at % 3 <> 0": ("r0", none, none),
        "at % 3 <> 2": ("t1", F.col("r1"), none),
        "at % 3 <> 1": ("t1", F.col("t2"), F.col("r2")),
    }
    found = None
    for residues, (a, b, c) in lists.items():
        order = ["k1", "k2", "k3", "piece", "sid", "at"]
        entries = ranked.filter(residues).select(F.col(a).alias("k1"), b.alias("k2"), c.alias("k3"), "piece", "sid", "at")
        hits = entries.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, "sid long, at int, first boolean")
        found = hits if found is None else found.unionByName(hits)
    return written(found.groupBy("sid", "at").agg(F.min("first").alias("first")), "sa-repeated")


# --- strings at the ends of repeats --------------------------------------------------------------


def _pack(hot: np.ndarray, n_buckets: int):
    columns = "bucket int, hashes binary, cids binary, starts binary, counts binary"

    def pack(batches):
        for batch in batches:
            cids = batch.column("cid").to_pylist()
            lows, sizes = batch.column("starts"), batch.column("counts")
            for i, j, data, off in blocks(batch.column("text"), CHUNK):
                parts = []
                for k in range(i, j):
                    low, size = np.asarray(lows[k].values).astype(np.int64), np.asarray(sizes[k].values).astype(np.int64)
                    wanted = np.sort(np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum()))
                    own = data[off[k - i] : off[k - i + 1]]
                    for at in range(0, len(own) - LENGTH + 1, CHUNK):  # all strings of a text at once, a long text by chunks
                        text = own[at : at + CHUNK + LENGTH - 1]
                        start = wanted[slice(*np.searchsorted(wanted, [at, at + CHUNK]))] - at
                        if len(start):
                            h = range_hash(prefix_hash(text), start, start + LENGTH)
                            least = window_minima(text)[start]
                            parts.append((h, np.where(np.isin(least, hot), h, mix(least)), np.full(len(start), cids[k], np.int64), at + start))
                if not parts:
                    continue
                h, place, cid, start = (np.concatenate(x) for x in zip(*parts, strict=True))
                bucket = (place % np.uint64(n_buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                h, bucket, cid, start = h[order], bucket[order], cid[order], start[order]
                new = np.ones(len(h), bool)  # runs of strings that follow one another
                new[1:] = (bucket[1:] != bucket[:-1]) | (cid[1:] != cid[:-1]) | (start[1:] != start[:-1] + 1)
                run = np.flatnonzero(new)
                counts = np.diff(np.append(run, len(h)))
                edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                run_edges = np.searchsorted(run, edges)
                rows = list(zip(edges[:-1], edges[1:], run_edges[:-1], run_edges[1:], strict=True))
                yield pa.record_batch(
                    [
                        pa.array(bucket[edges[:-1]], pa.int32()),
                        pa.array([h[a:b].tobytes() for a, b, _, _ in rows], pa.binary()),
                        pa.array([cid[run[c:d]].tobytes() for _, _, c, d in rows], pa.binary()),
                        pa.array([start[run[c:d]].astype(np.int32).tobytes() for _, _, c, d in rows], pa.binary()),
                        pa.array([counts[c:d].astype(np.int32).tobytes() for _, _, c, d in rows], pa.binary()),
                    ],
                    names=[c.split()[0] for c in columns.split(", ")],
                )

    return pack, columns


def _meet(table: pa.Table) -> pa.Table:
    """Of one bucket's strings, runs of those that occur twice: cid, low, size."""
    join = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
    h, cid, start, count = join("hashes", np.uint64), join("cids", np.int64), join("starts", np.int32), join("counts", np.int32)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
    owner = np.repeat(cid, count)
    at, owner = at[twice], owner[twice]
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return pa.table({"cid": pa.array(owner[first], pa.int64()), "low": pa.array(at[first], pa.int32()), "size": pa.array(np.diff(np.append(first, len(at))), pa.int32())})


# --- removal ---------------------------------------------------------------------------------


_SPANS = T.ArrayType(T.StructType().add("low", "integer").add("high", "integer"))


@F.arrow_udf(T.StructType().add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string").add("spans", _SPANS))
def _removed(text: pa.Array, lows: pa.Array, sizes: pa.Array) -> pa.Array:
    """Remove the strings that start at ``low`` to ``low + size - 1``."""
    out = []
    for i, j, data, off in blocks(text):
        for k in range(i, j):
            own = data[off[k - i] : off[k - i + 1]]
            low, size = np.asarray(lows[k].values).astype(np.int64), np.asarray(sizes[k].values).astype(np.int64)
            cover = np.zeros(len(own) + 1, np.int32)
            np.add.at(cover, low, 1)
            np.add.at(cover, np.minimum(len(own), low + size - 1 + LENGTH), -1)
            gone = np.cumsum(cover[:-1]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            spans = edge.reshape(-1, 2)
            out.append({"n_removed": int(gone.sum()), "n_spans": len(spans), "kept_sha256": hashlib.sha256(own[~gone]).hexdigest(), "spans": [{"low": int(a), "high": int(b)} for a, b in spans]})
    span = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    return pa.array(out, pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", span)]))


@F.arrow_udf(T.StringType())
def _sha(text: pa.Array) -> pa.Array:
    out = []
    for _, _, data, off in blocks(text):
        bounds = off.tolist()
        out += [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.array(out, pa.string())


def _fetch(texts: DataFrame, wanted: DataFrame, unique: bool) -> DataFrame:
    """The texts of ``wanted(cid, rep_id, rep_sha, ...)``, one row per class."""
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    found = texts.join(wanted, texts.doc_id.eqNullSafe(wanted.rep_id))
    if unique:
        return found
    return found.filter(_sha("text") == F.col("rep_sha")).dropDuplicates(["cid"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Null texts are empty.  A string of ``LENGTH`` bytes repeats if it starts at
    another place of the same or another row; equal rows repeat each other.
    ``spans`` are the removed byte ranges.  Other columns are not read.  An
    empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scan = written(texts.select("doc_id", _scan("text").alias("s")).select("doc_id", "s.*"), "sa-scan")
    total = scan.count()
    unique = scan.filter("doc_id is null").isEmpty() and scan.groupBy("doc_id").count().filter("count > 1").isEmpty()

    classes = scan.groupBy("sha").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep_id"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "sa-classes")
    one = scan.filter(F.size("pos") > 0).join(classes.select("sha", "cid", F.col("rep_id").alias("r")), "sha")
    one = one.filter(F.col("doc_id").eqNullSafe(F.col("r"))).select("cid", "pos", "h")
    one = written(one if unique else one.dropDuplicates(["cid"]), "sa-anchors")
    each = one.select("cid", F.explode(F.arrays_zip("pos", "h")).alias("z")).select("cid", "z.pos", "z.h")
    counted = written(each.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "sa-counted")
    n_anchors = one.agg(F.sum(F.size("pos"))).first()[0] or 0
    again = join_hot(each, counted, ["h"], "n", n_anchors).groupBy("cid").agg(F.collect_list("pos").alias("pos"))
    again = written(again.join(classes.select("cid", "rep_id", F.col("sha").alias("rep_sha")), "cid"), "sa-regions")

    cut = _fetch(texts, again, unique).select("cid", "text", "pos").mapInArrow(_phrase_rows, _PHRASES)
    strings = written(cut.withColumn("sid", F.monotonically_increasing_id()), "sa-strings")
    repeated = repeated_phrases(strings.select("sid", "symbols", "pieces"))

    located = strings.select("sid", "cid", F.posexplode(F.arrays_zip("starts", "counts")).alias("at", "z")).select("sid", "cid", "at", "z.starts", "z.counts").filter("counts > 0")
    located = written(located.join(repeated, ["sid", "at"], "left").select("cid", "starts", "counts", "first"), "sa-located")
    proved = located.filter("first is not null").select("cid", F.col("starts").alias("low"), F.col("counts").alias("size"))

    open_ = located.filter("first is null or first")
    n_open = open_.agg(F.sum("counts")).first()[0] or 0
    n_buckets = max(1, -(-n_open // BUCKET))
    ids = again.select("cid", "rep_id", "rep_sha")
    asked = written(open_.groupBy("cid").agg(F.collect_list("starts").alias("starts"), F.collect_list("counts").alias("counts")).join(ids, "cid"), "sa-asked")
    hot = np.array([r["h"] for r in counted.filter(F.col("n") * HOT_PARTS > n_anchors).select("h").collect()], np.int64).view(np.uint64)
    pack, columns = _pack(hot, n_buckets)
    packed = _fetch(texts, asked, unique).select("cid", "text", "starts", "counts").mapInArrow(pack, columns)
    met = packed.groupBy("bucket").applyInArrow(_meet, "cid long, low int, size int")
    runs = proved.unionByName(met).groupBy("cid").agg(F.collect_list("low").alias("lows"), F.collect_list("size").alias("sizes"))

    # Texts that occur once and have repeats are cut; equal texts of at least LENGTH bytes go whole.
    singles = classes.filter("copies = 1").select("cid", "rep_id", F.col("sha").alias("rep_sha"))
    cutting = written(runs.join(singles, "cid"), "sa-runs")
    done = _fetch(texts, cutting, unique).select("cid", _removed("text", "lows", "sizes").alias("r")).select("cid", "r.*")
    done = written(done, "sa-removed")
    nothing = F.array().cast(_SPANS)
    rows = join_hot(scan.select("doc_id", "sha", "n_bytes"), classes.select("sha", "cid", "copies"), ["sha"], "copies", total)
    once = rows.filter("copies = 1").join(done, "cid", "left")
    once = once.select("doc_id", "n_bytes", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_removed", "n_spans")], F.coalesce("kept_sha256", "sha").alias("kept_sha256"), F.coalesce("spans", nothing).alias("spans"))
    whole = F.col("n_bytes") >= LENGTH
    span = F.array(F.struct(F.lit(0).alias("low"), F.col("n_bytes").cast("int").alias("high")))
    several = rows.filter("copies > 1").select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(0).alias("n_removed"), whole.cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("sha")).alias("kept_sha256"), F.when(whole, span).otherwise(nothing).alias("spans"),
    )
    return once.unionByName(several)
