"""Toxicity of texts after noisy-channel deobfuscation.

A writer who hides a word replaces letters by look-alikes, spaces them out,
repeats them or stars them out.  Suspicious spans of a text become lattices:
each character offers the letters it may stand for, with the channel's
log-probability; separators within a spaced-out span may be dropped or kept as
a word boundary; a run of one letter may be one or two letters.  Viterbi
decoding under a character language model (4-grams counted over the whole
corpus) finds the likeliest letters.  The words of the text and the restored
words are then scored.  A run of more than ``STARS`` stars hides no letters (the
model alone would make them up) and is a boundary, so that the time to decode a
span grows with its length.

The scorer is fitted on a bounded sample of labelled documents outside the
held-out fold.  Features are words and beginnings of words.  One is kept if as
many toxic documents with it are so unlikely by chance (by Chernoff's bound on the
binomial tail at the sample's share of toxic documents) that among all features
tested fewer than ``BY_CHANCE`` are expected, and if its weight is high enough
(beginnings stand for many words and must be nearly always toxic).  Its weight
is the share of toxic documents among those that have it, smoothed by one
document of the average kind.  Each toxic document stands for the smallest hash of the contexts
(the word between its neighbours) in which it has the feature, and equal
contexts count once, so that copies of one document do not make its words
toxic.  A text's score is ``1 - product(1 - weight)`` over the distinct features it has.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicerefresh.llm.counters import summed
from slicerefresh.llm.shared import held_out, written
from slicerefresh.llm.text import LOWER_ASCII, blocks, mix, prefix_hash, range_hash, words

# --- character language model ---------------------------------------------------------------

#: Symbols: 0 word boundary, 1 to 26 letters, the rest by the last byte of a letter outside ASCII.
SYMBOLS, OTHER = 32, 27
_BITS = 20  # 4 symbols of 5 bits

_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[0x80:0xC0] = OTHER + np.arange(64) % (SYMBOLS - OTHER)


def _symbols(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Symbols of a block, with a boundary at the start of each row and no repeated boundaries."""
    keep = data < 0xC0  # the first byte of a longer character says nothing more
    sym = _SYMBOL[data]
    starts = off[:-1][off[:-1] < len(data)]
    sym = np.insert(sym, starts, 0)
    keep = np.insert(keep, starts, True)
    sym = sym[keep]
    same = np.zeros(len(sym), bool)
    same[1:] = (sym[1:] == 0) & (sym[:-1] == 0)
    return sym[~same]


def count_ngrams(batch: pa.RecordBatch) -> np.ndarray:
    total = np.zeros(1 << _BITS, np.int64)
    for _, _, data, off in blocks(batch.column(0)):
        sym = _symbols(data, off).astype(np.int64)
        if not len(sym):
            continue
        sym = np.concatenate([[0, 0, 0], sym, [0]])
        gram = (sym[:-3] << 15) | (sym[1:-2] << 10) | (sym[2:-1] << 5) | sym[3:]
        total += np.bincount(gram, minlength=1 << _BITS)
    return total


def language_model(counts: np.ndarray) -> np.ndarray:
    """log P(symbol | three before), interpolated over shorter histories; shape ``(32**3, 32)``.

    What stands before a word's first letter is cut off: a history does not
    reach beyond a boundary, so that words are decoded alike wherever they are.
    """
    c4 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    for k in range(SYMBOLS):
        if k:  # (k, 0, x) and (k, m, 0) become (0, 0, x) and (0, 0, 0)
            c4[0, 0] += c4[k, 0]
    c4[0, 0, 0] += c4[:, :, 0].sum(axis=(0, 1)) - c4[0, 0, 0]
    p1 = c4.sum(axis=(0, 1, 2)) + 1.0
    p = p1 / p1.sum()
    c2, c3 = c4.sum(axis=(0, 1)), c4.sum(axis=0)
    p2 = (c2 + 8 * p) / (c2.sum(-1, keepdims=True) + 8)
    p3 = (c3 + 4 * p2[None]) / (c3.sum(-1, keepdims=True) + 4)
    p4 = (c4 + 2 * p3[None]) / (c4.sum(-1, keepdims=True) + 2)
    return np.log(p4).reshape(SYMBOLS**3, SYMBOLS).astype(np.float32)


# --- lattices and decoding ------------------------------------------------------------------

# What a character may stand for besides itself.
LOOKALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
_ANY = "abcdefghijklmnopqrstuvwxyz"
_SUBSTITUTE, _STAR, _DROP, _BREAK, _SHORTEN = (float(np.log(p)) for p in (0.3, 0.5 / 26, 0.9, 0.1, 0.5))

#: Readings of spans up to this length are remembered; longer ones are decoded each time.
LONGEST = 64
#: Letters that stars may hide in a row.
STARS = 8

_SIGNS = r"@$!|+(<€£*"
_C = rf"[^\W_]|[{_SIGNS}]"
# Separators are no signs, so that a text can be read in one way only.
_SPACED = rf"(?<![^\W_])(?:{_C})(?:(?:[^\w{_SIGNS}]|_)+(?:{_C})(?![^\W_{_SIGNS}])(?![{_SIGNS}]*[^\W_])){{2,}}"
_DOTTED = r"(?<!\S)[^\W\d_](?:[.\-_~][^\W\d_])+(?!\w)"
# A match begins at the beginning of a token or word, so that a search takes one pass over it.
# Not whole: two stars or more at a word's edge are read as emphasis, for letters they take 0.1 s a word to decode.
_MIXED = rf"(?<!\S)(?=\S*?[^\W\d_])\S*?(?:[0-9@$!|+(<€£]|(?<!\*)\*(?!\*)|[^\W\d_]\*+[^\W\d_])\S*"
_REPEAT = r"(?<![^\W\d_])[^\W\d_]*?([^\W\d_])\1\1[^\W\d_]*"
SUSPICIOUS = re.compile(f"{_SPACED}|{_DOTTED}|{_MIXED}|{_REPEAT}", re.IGNORECASE)


def _symbol_of(letter: str) -> int:
    if "a" <= letter <= "z":
        return ord(letter) - 96
    return int(_SYMBOL[letter.encode()[-1]])


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Per position of the span the alternatives: text they stand for ("" nothing, " " a boundary), log-probability."""
    out: list[list[tuple[str, float]]] = []
    span = span.lower()
    i = 0
    while i < len(span):
        c, run = span[i], 1
        while i + run < len(span) and span[i + run] == c:
            run += 1
        if c == "*" and run > STARS:
            out.append([(" ", 0.0)])
        elif c == "*":
            out += [[*((x, _STAR) for x in _ANY), (" ", _BREAK)] for _ in range(run)]
        elif c in LOOKALIKE:
            # A sign may be punctuation; a digit may not.
            one = [(x, _SUBSTITUTE) for x in LOOKALIKE[c]] + ([] if c.isdigit() else [(" ", _BREAK)])
            out += [one] if run > 2 else [one] * run
        elif c.isalpha():
            out.append([(c, 0.0)])
            if run > 1:
                out.append([(c, 0.0 if run == 2 else _SHORTEN), ("", _SHORTEN)])
        else:
            out.append([("", _DROP), (" ", _BREAK)])
        i += run
    return out


def _any_letter(states: dict, cost: float, model: np.ndarray) -> dict:
    """The states after a character that may be any letter at the same cost."""
    history = np.fromiter(states, np.int64, len(states))
    score = np.array([x for x, _ in states.values()])
    chains = [x for _, x in states.values()]
    total = (score[:, None] + cost + model[history, 1:27]).ravel()
    nxt = (((history[:, None] << 5) | np.arange(1, 27)) & 0x7FFF).ravel()
    best = np.full(SYMBOLS**3, -np.inf)
    np.maximum.at(best, nxt, total)
    won = np.flatnonzero(total == best[nxt])
    value, first = np.unique(nxt[won], return_index=True)
    return {k: (float(total[at]), (chains[at // 26], _ANY[at % 26])) for k, at in zip(value.tolist(), won[first].tolist(), strict=True)}


def viterbi(options: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """The likeliest reading of a lattice; of equal ones the first in order."""
    # A reading is a chain of (what is before, letter), so that a step takes the same time in a span of any length.
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for alternatives in [*options, [(" ", 0.0)]]:
        after: dict[int, tuple[float, tuple | None]] = {}
        if len(alternatives) > 26:
            after, alternatives = _any_letter(states, alternatives[0][1], model), alternatives[26:]
        for history, (score, text) in states.items():
            for letter, cost in alternatives:
                if letter == "" or (letter == " " and history == 0):
                    nxt, total, read = history, score + cost, text
                else:
                    symbol = 0 if letter == " " else _symbol_of(letter)
                    total = score + cost + float(model[history, symbol])
                    nxt, read = (((history << 5) | symbol) & 0x7FFF if symbol else 0), (text, letter)
                if nxt not in after or total > after[nxt][0]:
                    after[nxt] = total, read
        states = after
    letters, chain = [], max(states.values(), key=lambda x: x[0])[1] if states else None
    while chain:
        chain, letter = chain
        letters.append(letter)
    return "".join(reversed(letters)).strip()


def restore(text: str, model: np.ndarray, decode=None) -> str:
    """The restored words of the suspicious spans of a text, each after a space."""
    decode = decode or (lambda span: viterbi(lattice(span), model))
    return " ".join(decode(m[0]) for m in SUSPICIOUS.finditer(text))


_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in "0123456789@$!|+(<*"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[0x80:] = True


def suspicious_rows(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows that may have a suspicious span; every match of SUSPICIOUS is in one.

    Rows with other characters than ASCII and the letters from U+00C0 to U+00FF
    are all in.  In others, a match of _MIXED lies between spaces and has a
    letter and a sign; one of _REPEAT has three equal letters.  One of _SPACED
    has a lone character between two that are alone or beside a sign, and one of
    _DOTTED a lone letter, one separator, and a letter that is alone or beside a sign.
    """
    out = np.zeros(len(off) - 1, bool)
    if not len(data):
        return out
    row_of = lambda at: np.searchsorted(off, at, "right") - 1
    # A space stands for the text's start and end; rows meet without a gap, which only flags too many.
    wide = np.concatenate([data, np.full(6, 32, np.uint8)])
    n, lead = len(data), data == 0xC3
    at = lambda k: wide[k : n + k]
    out[row_of(np.flatnonzero((data >= 0xC0) & ~lead | lead & ((at(1) == 0x97) | (at(1) == 0xB7))))] = True
    low = LOWER_ASCII[wide]
    three = _LETTER[data] & (low[:n] == low[1 : n + 1]) & (low[:n] == low[2 : n + 2])
    three |= lead & (at(2) == 0xC3) & (at(4) == 0xC3) & ((at(3) | 32) == (at(1) | 32)) & ((at(5) | 32) == (at(1) | 32))  # whatever their case
    out[row_of(np.flatnonzero(three))] = True
    upto = lambda x: np.concatenate([[0], np.cumsum(x)])
    letters, signs = upto(_LETTER[data]), upto(_SIGN[data])
    start, end, row = words(data, off)
    out[row[(letters[end] > letters[start]) & (signs[end] > signs[start])]] = True
    start, end, row = words(data, off, ~(_LETTER | _SIGN))
    if len(start) > 1:
        alone = (end - start == 1) | (end - start == 2) & (data[start] >= 0x80)
        near = alone | (signs[end] > signs[start])
        follows = row[1:] == row[:-1]
        dotted = follows & alone[:-1] & near[1:] & (start[1:] == end[:-1] + 1) & np.isin(data[end[:-1].clip(max=n - 1)], np.frombuffer(b".-_~", np.uint8))
        out[row[1:][dotted]] = True
        out[row[1:-1][follows[:-1] & follows[1:] & near[:-2] & alone[1:-1] & near[2:]]] = True
    return out


# --- features --------------------------------------------------------------------------------

#: A feature is a whole word (0) or its first so many bytes; its lowest bits say which of these.
PREFIXES = (0, 4, 5, 6, 7)
_KIND = np.uint64(7)
_NOT_LETTER = ~_LETTER


def _lower(data: np.ndarray) -> np.ndarray:
    out = LOWER_ASCII[data]
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1
    upper = latin[(data[latin] >= 0x80) & (data[latin] <= 0x9E) & (data[latin] != 0x97)]
    out[upper] += 0x20
    return out


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of a block's words, the row of each, and the context of each (the word and its neighbours)."""
    start, end, row = words(data, off, _NOT_LETTER)
    if not len(start):
        none = np.empty(0, np.uint64)
        return none, np.empty(0, np.int64), none
    prefix = prefix_hash(_lower(data))
    whole = range_hash(prefix, start, end)
    near = np.concatenate([np.zeros(1, np.uint64), whole, np.zeros(1, np.uint64)])
    near_row = np.concatenate([[-1], row, [-1]])
    left = np.where(near_row[:-2] == row, near[:-2], np.uint64(1))
    right = np.where(near_row[2:] == row, near[2:], np.uint64(2))
    context = mix(left * np.uint64(3) + mix(whole + right * np.uint64(5)))
    feats, rows, contexts = [], [], []
    for kind, length in enumerate(PREFIXES):
        some = end - start >= max(3, length) if not length else end - start > length
        h = range_hash(prefix, start[some], start[some] + length) if length else whole[some]
        feats.append(mix(h + np.uint64(length)) & ~_KIND | np.uint64(kind))
        rows.append(row[some])
        contexts.append(context[some])
    return np.concatenate(feats), np.concatenate(rows), np.concatenate(contexts)


def once_per_row(feats: np.ndarray, rows: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of each row with their smallest context."""
    order = np.lexsort((contexts, feats, rows))
    f, r, c = feats[order], rows[order], contexts[order]
    first = np.ones(len(f), bool)
    first[1:] = (f[1:] != f[:-1]) | (r[1:] != r[:-1])
    return f[first], c[first]


class Reader:
    """Original and restored words of Arrow texts, as features."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model
        self.remember = lru_cache(200_000)(lambda span: viterbi(lattice(span), model))

    def decode(self, span: str) -> str:
        return self.remember(span) if len(span) <= LONGEST else viterbi(lattice(span), self.model)

    def read(self, column: pa.Array):
        """Yield ``(first row, end row, features, rows, contexts)`` for blocks of texts."""
        for i, j, data, off in blocks(column):
            feats, rows, contexts = features(data, off)
            odd = np.flatnonzero(suspicious_rows(data, off))
            restored = [restore(bytes(data[off[k] : off[k + 1]]).decode("utf-8", "replace"), self.model, self.decode) for k in odd.tolist()]
            if any(restored):
                for a, _, more, more_off in blocks(pa.array(restored, pa.string())):
                    f, r, c = features(more, more_off)
                    feats, rows, contexts = np.concatenate([feats, f]), np.concatenate([rows, odd[a + r]]), np.concatenate([contexts, c])
            yield i, j, feats, rows, contexts


# --- fit and score ---------------------------------------------------------------------------

#: Labelled documents that the scorer is fitted on, at most.
FIT_TOXIC, FIT_CLEAN = 2_000, 8_000
#: Contexts of a feature at least, features that may be kept by chance, weights of words and of beginnings at least.
MIN_CONTEXTS, BY_CHANCE, MIN_WORD, MIN_BEGINNING = 3, 3.0, 0.8, 0.9
DECIDE = 0.3


def log_chance(n_toxic: np.ndarray, n: np.ndarray, base: float) -> np.ndarray:
    """Chernoff's bound on the log-probability of ``n_toxic`` or more of ``n`` documents at a share of ``base``."""
    if not 0 < base < 1:
        return np.zeros(len(n))
    share = n_toxic / n
    clean = np.maximum(1 - share, 1e-300)
    divergence = share * np.log(np.maximum(share, 1e-300) / base) + (1 - share) * np.log(clean / (1 - base))
    return np.where(share > base, -n * divergence, 0.0)


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """A bounded sample of labelled texts (text, toxic), and by how much less of the clean than of the toxic ones it has."""
    known = labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = written(known.filter(~held_out(F.col("doc_id"))), "tox-labels")
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    parts = [known.filter(F.col("toxic") == value).orderBy(order, "doc_id").limit(most) for value, most in ((1, FIT_TOXIC), (0, FIT_CLEAN))]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    scale = (max(1, n.get(0, 0)) / min(max(1, n.get(0, 0)), FIT_CLEAN)) / (max(1, n.get(1, 0)) / min(max(1, n.get(1, 0)), FIT_TOXIC))
    return docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic"), scale


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Language model and feature weights (``docs``: doc_id, text; ``labels``: doc_id, toxic)."""
    spark = docs.sparkSession
    model = language_model(summed(docs.select("text"), count_ngrams, _BITS))
    shared_model = spark.sparkContext.broadcast(model)
    sample, scale = _sample(docs, labels)
    sample = written(sample, "tox-sample")
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def contexts_of(batches):
        reader = Reader(shared_model.value)
        for batch in batches:
            for _, _, feats, rows, contexts in reader.read(batch.column("text")):
                feats, contexts = once_per_row(feats, rows, contexts)
                yield pa.record_batch({"feature": pa.array(feats.view(np.int64)), "context": pa.array(contexts.view(np.int64))})

    seen = sample.filter("toxic = 1").select("text").mapInArrow(contexts_of, "feature long, context long").distinct()
    toxic = seen.groupBy("feature").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_CONTEXTS).toArrow()
    feature = toxic["feature"].to_numpy().view(np.uint64)
    order = np.argsort(feature)
    feature, n_toxic = feature[order], toxic["n"].to_numpy().astype(float)[order]
    shared_features = spark.sparkContext.broadcast(feature)

    def clean_counts(batches):
        reader, known = Reader(shared_model.value), shared_features.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, _, feats, rows, contexts in reader.read(batch.column("text")):
                feats, _ = once_per_row(feats, rows, contexts)
                at = np.searchsorted(known, feats)
                at = at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == feats)] if len(known) else at[:0]
                total += np.bincount(at, minlength=len(known))
        some = np.flatnonzero(total)
        yield pa.record_batch({"at": pa.array(some, pa.int64()), "n": pa.array(total[some], pa.int64())})

    clean = sample.filter("toxic = 0").select("text").mapInArrow(clean_counts, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    n_clean = np.zeros(len(feature))
    n_clean[clean["at"].to_numpy()] = clean["n"].to_numpy()
    by_chance = log_chance(n_toxic, n_toxic + n_clean, size.get(1, 0) / max(1, size.get(0, 0) + size.get(1, 0)))
    n_clean *= scale  # as if all clean documents had been read
    base = size.get(1, 0) / max(1, size.get(1, 0) + size.get(0, 0) * scale)
    weight = (n_toxic + base) / (n_toxic + n_clean + 1)
    least = np.where(feature & _KIND == 0, MIN_WORD, MIN_BEGINNING)
    good = (by_chance + np.log(max(1, len(feature))) < np.log(BY_CHANCE)) & (weight >= least)
    return {"model": model, "feature": feature[good], "weight": weight[good]}


def scorer(fitted: dict, spark):
    """A column function: text -> score."""
    shared = spark.sparkContext.broadcast(fitted)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        known, weight = shared.value["feature"], shared.value["weight"]
        reader = Reader(shared.value["model"])
        maybe = np.zeros(1 << 16, bool)
        maybe[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
        out = np.zeros(len(text))
        for i, j, feats, rows, _ in reader.read(text):
            near = np.flatnonzero(maybe[(feats & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.searchsorted(known, feats[near])
            hit = (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == feats[near]) if len(known) else np.zeros(0, bool)
            pairs = np.unique(np.stack([rows[near[hit]], at[hit]], 1), axis=0) if hit.any() else np.empty((0, 2), np.int64)
            clean = np.bincount(pairs[:, 0], np.log1p(-np.minimum(weight[pairs[:, 1]], 0.9999)), minlength=j - i)
            out[i:j] = 1 - np.exp(clean)
        return pa.array(np.clip(out, 0.0, 1.0))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, fitted: dict | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null and empty texts, and texts without a known feature, score 0; without
    labels every text does.  Of contradicting labels of one id the toxic one
    counts; null labels and ids are not learned from.  Other columns are not
    read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    score = scorer(fitted or fit(rows, labels), docs.sparkSession)
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= DECIDE).cast("int"))
