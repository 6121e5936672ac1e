"""Exact Jaccard join of word n-gram sets by skipping along set relations.

Tokens (hashed shingles, four words wide unless told otherwise) have one global
order: seldom ones first, by a fixed-size sketch of their counts, then by hash.
Sets with a similarity of at least ``share`` (85 / 100 unless told otherwise)
share a token among the first ``n - ceil(share n) + 1`` of each (their
prefixes), so an index of prefixes finds all links.

Two relations between sets save most of the work:

* Index lists are cut into blocks by size (bands a factor ``1 / share`` apart), so that
  a set meets only the blocks of its own and the adjoining bands; a pair leaves
  only lists whose token can be the first that both share, what is left of each
  set behind it being enough for a link.
* Equal sets have equal answers and are one class.  In rounds, the sets of each
  list are compared with one hub of it (a set with few seldom tokens of its own, so
  that most are near it), another one each round; a set similar
  to a hub joins the hub's component, and lists whose sets are all in one
  component are skipped from then on.  Rounds go on while each halves the pairs
  that are left, until there are no more than ``PAIRS`` per index entry.
  Where the overlap of two hubs is known, that of their followers lies within
  the differences and is counted only if these bounds do not decide.

Every pair across components that is left and passes the bounds is counted exactly.

Bit arrays of a fixed size keep what cannot matter out of the shuffles (tokens
of one set, sets without a copy); they only save work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicerefresh.llm.components import components
from slicerefresh.llm.counters import summed
from slicerefresh.llm.shared import join_hot, unique_ids, without, written
from slicerefresh.llm.text import blocks, list_array, mix, row_bounds, shingle_hashes, signed, word_hashes, words

#: Words of a shingle, and linked sets (``share[1] * intersection >= share[0] * union``), unless told otherwise.
WIDTH = 4
SHARE = (85, 100)
#: Counters of the sketch of token counts.
SKETCH_BITS = 21
#: Bits (as a power of 2) of the arrays that tell rows apart before a shuffle: 4 MB.
BITS = 25
#: Pairs per index entry that may be emitted at the end instead of another round.
PAIRS = 1
#: Up to so many ids of sets to compare are broadcast (about 50 MB); more are joined by a shuffle.
BROADCAST_IDS = 500_000


def _sets(text: pa.Array, width: int):
    """Yield ``(shingle hashes, bounds of each text, number of texts)``, repeats included."""
    for i, j, data, off in blocks(text):
        start, end, row = words(data, off)
        h, h_row, _ = shingle_hashes(word_hashes(data, start, end), row, width, j - i)
        yield h, row_bounds(h_row, j - i), j - i


def token_order(texts: DataFrame, width: int = WIDTH) -> np.ndarray:
    """Counts (65535 at most) of the tokens by hash value, of fixed size."""

    def count(batch):
        counters = np.zeros(1 << SKETCH_BITS, np.int64)
        for h, _, _ in _sets(batch.column("text"), width):
            at, n = np.unique(h & np.uint64((1 << SKETCH_BITS) - 1), return_counts=True)
            counters[at.astype(np.int64)] += n
        return counters

    return np.minimum(summed(texts.select("text"), count, SKETCH_BITS), 65535).astype(np.uint16)


def _ordered(h: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Distinct tokens (whole 64-bit hashes) in the global order: by count, then by hash."""
    h = np.unique(h)
    return h[np.argsort(order[(h & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)], kind="stable")]


def _signature(tokens: np.ndarray) -> np.uint64:
    return mix(np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64))[0]


def _describe(shared, whole: bool, width: int, share: tuple[int, int]):
    """Text -> size, signature and prefix of its set, or with ``whole`` all tokens."""

    @F.arrow_udf("struct<n: int, sig: bigint, tokens: array<bigint>>")
    def describe(text: pa.Array) -> pa.Array:
        order = shared.value
        sizes, signatures, parts = [], [], []
        for h, at, n_rows in _sets(text, width):
            for k in range(n_rows):
                tokens = _ordered(h[at[k] : at[k + 1]], order)
                n = len(tokens)
                sizes.append(n)
                signatures.append(_signature(tokens))
                # A copy, so that the rest is not held until the batch ends.
                parts.append(tokens if whole else tokens[: n - -(-n * share[0] // share[1]) + 1 if n else 0].copy())
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int32()), pa.array(signed(np.array(signatures, np.uint64))), list_array(bounds, pa.array(signed(flat)))], ["n", "sig", "tokens"]
        )

    return describe


@F.arrow_udf(T.IntegerType())
def _overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    """Intersections of lists of distinct tokens."""
    av, bv = a.values.to_numpy().view(np.uint64), b.values.to_numpy().view(np.uint64)
    ao, bo = a.offsets.to_numpy(), b.offsets.to_numpy()
    return pa.array([len(np.intersect1d(av[ao[k] : ao[k + 1]], bv[bo[k] : bo[k + 1]], assume_unique=True)) for k in range(len(a))], pa.int32())


def _needed(n: Column, m: Column, share: tuple[int, int]) -> Column:
    """The least overlap of linked sets of these sizes."""
    return F.ceil((n + m) * F.lit(share[0]) / F.lit(sum(share)))


def _sizes_fit(n: Column, m: Column, share: tuple[int, int]) -> Column:
    return F.least(n, m) * share[1] >= F.greatest(n, m) * share[0]


def _may(n: Column, m: Column, i: Column, j: Column, share: tuple[int, int]) -> Column:
    """Whether sets of these sizes may be linked if these are the positions of their first shared token.

    With tokens before it shared, pairs meet at these too: where this holds at
    one shared token, it holds at all earlier ones.
    """
    return _sizes_fit(n, m, share) & (F.least(n - i, m - j) >= _needed(n, m, share))


def _possible(met: DataFrame, share: tuple[int, int], *more: Column) -> DataFrame:
    """Pairs that may be linked by their sizes and the positions of their shared prefix tokens: a, b, n_a, n_b, shared."""
    per_pair = met.groupBy("a", "b").agg(F.count("*").alias("shared"), *[F.max(c).alias(c) for c in ("n_a", "n_b", "pos_a", "pos_b")], *more)
    # All shared tokens up to the last one are counted; after it, no more than what is left.
    bound = F.col("shared") + F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) - 1
    return per_pair.filter(_sizes_fit(F.col("n_a"), F.col("n_b"), share) & (bound >= _needed(F.col("n_a"), F.col("n_b"), share))).drop("pos_a", "pos_b")


def _counted(pairs: DataFrame, fetch, tag: str) -> DataFrame:
    """Exact overlaps of ``pairs(a, b)``: a, b, n_a, n_b, overlap."""
    sets = fetch(pairs)
    left = sets.select(F.col("sig").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = sets.select(F.col("sig").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return written(both.select("a", "b", "n_a", "n_b", _overlap("t_a", "t_b").alias("overlap")), tag)


def _linked(counted: DataFrame, share: tuple[int, int]) -> DataFrame:
    return counted.filter(F.col("overlap") >= _needed(F.col("n_a"), F.col("n_b"), share))


def _bits(keys: DataFrame) -> np.ndarray:
    """Bit array of ``2 ** BITS`` bits with one set for every ``sig`` of ``keys``, put together piece by piece."""
    piece_bits = 16
    n_pieces = 1 << (BITS - piece_bits)

    def places(batches):
        for batch in batches:
            h = batch.column("sig").to_numpy().view(np.uint64) >> np.uint64(64 - BITS)
            yield pa.record_batch({"piece": pa.array((h >> np.uint64(piece_bits)).astype(np.int32)), "at": pa.array((h & np.uint64((1 << piece_bits) - 1)).astype(np.int32))})

    def pack(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            piece, at = batch.column("piece").to_numpy(), batch.column("at").to_numpy()
            for k in np.unique(piece).tolist():
                held.setdefault(k, np.zeros(1 << piece_bits, bool))[at[piece == k]] = True
        for k, bits in held.items():
            yield pa.record_batch({"piece": pa.array([k], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()])})

    out = np.zeros((n_pieces, 1 << piece_bits - 3), np.uint8)
    dealt = keys.mapInArrow(places, "piece int, at int").repartition(64, "piece")
    for r in dealt.mapInArrow(pack, "piece int, bits binary").collect():
        out[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    h = keys.view(np.uint64) >> np.uint64(64 - BITS)
    return (bits[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _in_bits(bits: np.ndarray, spark):
    """Column -> whether a 64-bit value may be among those whose bits are set."""
    shared = spark.sparkContext.broadcast(bits)

    @F.arrow_udf(T.BooleanType())
    def held(keys: pa.Array) -> pa.Array:
        return pa.array(_held(shared.value, keys.to_numpy(zero_copy_only=False)))

    return held


def _listed(classes: DataFrame, bits: np.ndarray) -> DataFrame:
    """Index entries ``sig, n, pos, token`` of the tokens whose bits are set."""
    shared = classes.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            tokens = batch.column("tokens")
            flat = tokens.values.to_numpy(zero_copy_only=False)
            at = tokens.offsets.to_numpy().astype(np.int64)
            keep = np.flatnonzero(_held(shared.value, flat[at[0] : at[-1]])) + at[0]
            row = np.searchsorted(at, keep, "right") - 1
            yield pa.record_batch(
                {
                    "sig": pa.array(batch.column("sig").to_numpy()[row]),
                    "n": pa.array(batch.column("n").to_numpy()[row]),
                    "pos": pa.array((keep - at[row]).astype(np.int32)),
                    "token": pa.array(flat[keep]),
                }
            )

    return classes.mapInArrow(run, "sig long, n int, pos int, token long")


def _with_component(classes: DataFrame, links: DataFrame) -> DataFrame:
    if links.isEmpty():
        return classes.withColumn("comp", F.col("sig"))
    comps = components(links)
    return classes.join(comps.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, share: tuple[int, int] = SHARE) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, n_copies, sig, comp.

    Sets hold the shingles of ``width`` words; those with a similarity of
    ``share[0] / share[1]`` or more are linked.
    ``component_id`` is the smallest id reachable by links, ``n_copies`` the
    number of rows with the same set; ``sig`` names the set and ``comp`` the
    component (null for an empty set).  Null texts and texts without words have
    an empty set, link with nothing and are their own component.  Null ids are
    largest.  Other columns are not read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(token_order(texts, width))
    rows = written(texts.select("doc_id", _describe(shared, False, width, share)("text").alias("s")).select("doc_id", "s.*"), "sets")
    full = rows.filter("n > 0")

    # Classes of equal sets.
    counts = full.groupBy("sig").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("first_id"))
    counts = written(counts, "set-classes")
    copied = _in_bits(_bits(counts.filter("n_copies > 1").select("sig")), spark)
    prefixes = full.select("sig", "n", "tokens").withColumn("copied", copied("sig"))
    classes = prefixes.filter("copied").dropDuplicates(["sig"]).unionByName(prefixes.filter("not copied")).drop("copied")
    classes = written(classes, "set-prefixes")
    index = classes.select("sig", "n", F.posexplode("tokens").alias("pos", "token"))
    lists = written(index.groupBy("token").agg(F.count("*").alias("size")).filter("size > 1").select("token"), "set-lists")
    entries = written(_listed(classes, _bits(lists.select(F.col("token").alias("sig")))).join(lists, "token"), "set-entries")
    by_id = counts.select("sig", "first_id")
    one_row = unique_ids(full)

    def fetch(pairs: DataFrame) -> DataFrame:
        """All tokens of the sets in ``pairs``: sig, n, tokens."""
        used = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
        used = written(used.join(by_id, "sig"), "set-used")
        ids = F.broadcast(used) if used.count() <= BROADCAST_IDS else used
        found = texts.join(ids, texts.doc_id.eqNullSafe(ids.first_id)).select("text", F.col("sig").alias("own"))
        sets = written(found.select("own", _describe(shared, True, width, share)("text").alias("s")).select("own", "s.*"), "set-tokens").filter("own = sig").drop("own")
        return sets if one_row else sets.dropDuplicates(["sig"])

    # Rounds: in each list one hub that was none before, the one with the token nearest its start; every
    # set is compared with the hub it shares most lists with, of each component.
    n_entries, links, known, round_, before = entries.count(), None, classes.select("sig", F.col("sig").alias("comp")), 0, 0
    done = spark.createDataFrame([], "x long, y long")
    while True:
        named = entries.drop("comp").join(known, "sig") if round_ else entries.withColumn("comp", F.col("sig"))
        entries = written(named, "set-open") if round_ else named
        spread = entries.groupBy("token", "comp").agg(F.count("*").alias("k")).groupBy("token").agg(
            F.count("*").alias("comps"), F.sum("k").alias("size"), F.sum(F.col("k") * F.col("k")).alias("same")
        )
        open_ = written(spread.filter("comps > 1"), "set-spread")
        entries = entries.join(open_.select("token"), "token", "left_semi")
        left = open_.agg(F.sum((F.col("size") * F.col("size") - F.col("same")) / 2)).first()[0] or 0
        if round_ and (left <= PAIRS * n_entries or 2 * left > before):
            break
        before = left
        # A token comes early in sets that have few seldom tokens of their own, which most others resemble.
        early, pick = F.col("pos") / F.col("n"), F.xxhash64(F.lit(round_), "sig")
        others = entries.join(F.broadcast(hubs) if hubs.count() <= BROADCAST_IDS else hubs, "sig", "left_anti") if round_ else entries
        hub = others.groupBy("token").agg(F.min(F.struct(early.alias("early"), pick.alias("pick"), "sig", "n", "pos", "comp")).alias("hub"))
        hub = hub.select("token", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("sig", "n", "pos", "comp")])
        met = entries.join(hub, "token").filter((F.col("comp") != F.col("hub_comp")) & _may(F.col("n"), F.col("hub_n"), F.col("pos"), F.col("hub_pos"), share))
        met = met.select(F.col("sig").alias("a"), F.col("hub_sig").alias("b"), F.col("n").alias("n_a"), F.col("hub_n").alias("n_b"), F.col("pos").alias("pos_a"), F.col("hub_pos").alias("pos_b"), F.col("hub_comp").alias("comp"))
        fresh = _possible(met, share, F.max("comp").alias("comp")).withColumns({"x": F.least("a", "b"), "y": F.greatest("a", "b")})
        fresh = fresh.join(done, ["x", "y"], "left_anti")
        best = fresh.groupBy("a", "comp").agg(F.max(F.struct("shared", "b")).alias("best"))
        best = written(best.select("a", F.col("best.b").alias("b")), "set-hubs")
        were = best.select(F.col("b").alias("sig"))
        hubs = written((hubs.unionByName(were) if round_ else were).distinct(), "set-hub-ids")
        counted = _counted(best, fetch, "set-to-hub")
        done = written(done.unionByName(counted.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))).distinct(), "set-done")
        found = _linked(counted, share)
        if found.isEmpty():
            break
        links = found if links is None else written(links.unionByName(found), "set-links")
        known = _with_component(classes.select("sig"), links.select("a", "b"))
        round_ += 1
    pairs = _cross_pairs(entries, share).withColumns({"x": F.col("a"), "y": F.col("b")}).join(done, ["x", "y"], "left_anti").drop("x", "y")
    more = _decide(pairs, links, fetch, share) if links is not None else _linked(_counted(pairs, fetch, "set-hub-pairs"), share).select("a", "b")
    every = more if links is None else links.select("a", "b").unionByName(more)

    final = _with_component(counts, every)
    smallest = final.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    named = written(final.join(smallest, "comp").select("sig", "n_copies", "component_id", "comp"), "set-components")
    out = join_hot(full.drop("tokens"), named, ["sig"], "n_copies", rows.count())
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "n_copies", "sig", "comp"]
    empty = rows.filter("n = 0").withColumns({"component_id": F.col("doc_id"), "n_copies": F.lit(1).cast("long"), "comp": F.lit(None).cast("long")})
    return out.select(columns).unionByName(empty.select(columns))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, share: tuple[int, int] = SHARE) -> DataFrame:
    """The row with the smallest id of every component, with its columns; rows with an empty set all stay."""
    found = written(link_components(docs, id_col, text_col, width, share), "components")
    if unique_ids(found):
        return without(docs, found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("drop_id")), id_col)
    # Rows share an id: find them by id and set, and keep one of rows that are equal in both.
    first = found.filter("comp is not null").groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sig")).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("__keep_id"), F.col("first.sig").alias("__keep_sig"))
    texts = docs.select(F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(token_order(texts, width))
    rows = docs.select("*", _describe(shared, False, width, share)(F.col(text_col)).alias("__s")).select("*", F.col("__s.n").alias("__n"), F.col("__s.sig").alias("__sig"))
    same = F.col(id_col).eqNullSafe(F.col("__keep_id")) & (F.col("__sig") == F.col("__keep_sig"))
    some = rows.filter("__n > 0").join(kept, same, "left_semi").dropDuplicates([id_col, "__sig"])
    return some.unionByName(rows.filter("__n = 0")).select(*docs.columns)


def _cross_pairs(entries: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs of different components that may be linked: a, b."""
    per = entries.groupBy("token", "comp").agg(F.count("*").alias("n"))
    lists = per.groupBy("token").agg(F.count("*").alias("comps"), F.max(F.struct("n", "comp")).alias("top")).filter("comps > 1")
    lists = lists.select("token", F.col("top.comp").alias("main"))
    open_ = written(entries.join(lists, "token").withColumn("band", F.floor(F.log(F.col("n")) / F.log(F.lit(share[1] / share[0]))).cast("int")), "set-open")
    few = open_.filter("comp <> main").withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    p = few.select("token", "band", *[F.col(c).alias(f"p_{c}") for c in ("sig", "n", "comp", "pos")])
    q = open_.select("token", "band", "main", *[F.col(c).alias(f"q_{c}") for c in ("sig", "n", "comp", "pos")])
    met = p.join(q, ["token", "band"]).filter(
        (F.col("p_comp") != F.col("q_comp")) & ((F.col("q_comp") == F.col("main")) | (F.col("p_sig") < F.col("q_sig"))) & _may(F.col("p_n"), F.col("q_n"), F.col("p_pos"), F.col("q_pos"), share)
    )
    swap = F.col("p_sig") < F.col("q_sig")
    pick = lambda x, y: F.when(swap, F.col(x)).otherwise(F.col(y))
    ordered = met.select(*[pick(f"p_{c}", f"q_{c}").alias(f"{c}_a") for c in ("sig", "n", "pos")], *[pick(f"q_{c}", f"p_{c}").alias(f"{c}_b") for c in ("sig", "n", "pos")])
    ordered = ordered.withColumnsRenamed({"sig_a": "a", "sig_b": "b"})
    return written(_possible(ordered, share).drop("shared"), "set-pairs")


def _decide(pairs: DataFrame, links: DataFrame, fetch, share: tuple[int, int]) -> DataFrame:
    """Links among ``pairs``: of hubs first, of their followers from these where the bounds decide."""
    follow = links.select(F.col("a").alias("sig"), F.col("b").alias("hub"), (F.col("n_a") - F.col("overlap")).alias("own"), (F.col("n_b") - F.col("overlap")).alias("missing"))
    for side in "ab":
        renamed = follow.select(F.col("sig").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("hub", "own", "missing")])
        pairs = pairs.join(renamed, side, "left")
    pairs = written(
        pairs.select("a", "b", "n_a", "n_b", *[F.coalesce(F.col(f"hub_{s}"), F.col(s)).alias(f"hub_{s}") for s in "ab"], *[F.coalesce(F.col(f"{c}_{s}"), F.lit(0)).alias(f"{c}_{s}") for c in ("own", "missing") for s in "ab"]),
        "set-follow",
    )
    hubs = pairs.filter("hub_a = a and hub_b = b")
    first = _counted(hubs, fetch, "set-hub-pairs")
    lookup = first.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), F.col("overlap").alias("of_hubs"))
    rest = pairs.filter("hub_a <> a or hub_b <> b").join(lookup, (F.least("hub_a", "hub_b") == F.col("x")) & (F.greatest("hub_a", "hub_b") == F.col("y")), "left")
    need = _needed(F.col("n_a"), F.col("n_b"), share)
    least = F.col("of_hubs") - F.col("missing_a") - F.col("missing_b")
    most = F.col("of_hubs") + F.col("own_a") + F.col("own_b")
    rest = rest.withColumn("sure", F.coalesce(least >= need, F.lit(False))).withColumn("never", F.coalesce(most < need, F.lit(False)))
    second = _counted(rest.filter("not sure and not never"), fetch, "set-followers")
    return _linked(first, share).select("a", "b").unionByName(rest.filter("sure").select("a", "b")).unionByName(_linked(second, share).select("a", "b"))
