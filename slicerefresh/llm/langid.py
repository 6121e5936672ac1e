"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds one slot per hash value and in each slot one
bit per language; the AND of an n-gram's slots names, in one look-up, every
language whose set contains the n-gram.  A text's n-grams are looked up
together; the popcount of each language's bit, corrected for the share of
n-grams that its filter contains by chance, decides.

N-grams are ``N_BYTES`` UTF-8 bytes of the text with letters lower-cased
(ASCII and Latin-1) and every run of other ASCII characters made one space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicerefresh.llm.shared import held_out
from slicerefresh.llm.text import LOWER_ASCII, blocks, mix, row_bounds

N_BYTES = 4
SLOT_BITS = 20
HASHES = 3
#: The filters are fitted on about so many labelled documents of each language at most (a hash of the id chooses).
FIT_DOCS = 4_000
#: A language's set has the n-grams seen this often in its sample, unless another language has them this many times as often.
MIN_COUNT, MAX_RATIO = 3, 8.0
UNKNOWN = "und"
#: Rejected: texts without a language, and those of this many n-grams of which no language has this share.
REJECT_GRAMS, REJECT_SHARE = 100, 0.2

_FOLD = LOWER_ASCII.copy()
_FOLD[[b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)]] = 32


def normalised(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes without repeated spaces, and the row of each."""
    out = _FOLD[data]
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1
    upper = latin[(data[latin] >= 0x80) & (data[latin] <= 0x9E) & (data[latin] != 0x97)]
    out[upper] += 0x20
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 32) | (out[:-1] != 32)
    keep[off[:-1][off[:-1] < len(out)]] = True
    at = np.flatnonzero(keep)
    return out[at], np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(at, off)))


def ngrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a block as integers of their bytes, and the row of each."""
    out, row = normalised(data, off)
    m = len(out) - N_BYTES + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    gram = np.zeros(m, np.uint64)
    for k in range(N_BYTES):
        gram = (gram << np.uint64(8)) | out[k : k + m]
    whole = row[:m] == row[N_BYTES - 1 :]
    return gram[whole], row[:m][whole]


def slots(gram: np.ndarray) -> list[np.ndarray]:
    h = mix(gram + np.uint64(0x9E3779B97F4A7C15))
    return [((h >> np.uint64(k * SLOT_BITS)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for k in range(HASHES)]


class LanguageFilters:
    """The bit-sliced filter: ``slices[w, slot]`` holds the bits of languages ``64 w`` to ``64 w + 63``."""

    def __init__(self, languages: list[str], sets: list[np.ndarray], sizes: list[int]) -> None:
        self.languages = languages
        self.likeliest = int(np.argmax(sizes)) if sizes else 0
        self.slices = np.zeros((max(1, -(-len(languages) // 64)), 1 << SLOT_BITS), np.uint64)
        for lang, grams in enumerate(sets):
            for at in slots(grams):
                self.slices[lang // 64, at] |= np.uint64(1 << lang % 64)
        #: Chance that a filter contains an n-gram outside the language's set.
        self.chance = [float(self._bit(self.slices[lang // 64], lang).mean() ** HASHES) for lang in range(len(languages))]

    @staticmethod
    def _bit(masks: np.ndarray, lang: int) -> np.ndarray:
        return (masks >> np.uint64(lang % 64)) & np.uint64(1)

    def shares(self, gram: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        """Corrected share of each row's n-grams in each language, ``n_rows`` by languages."""
        bounds = row_bounds(row, n_rows)
        total = np.diff(bounds)
        some = np.flatnonzero(total)
        out = np.zeros((n_rows, len(self.languages)))
        if not len(some):
            return out
        at = slots(gram)
        for word, slice_ in enumerate(self.slices):
            masks = slice_[at[0]]
            for more in at[1:]:
                masks &= slice_[more]
            for lang in range(64 * word, min(64 * word + 64, len(self.languages))):
                hits = np.add.reduceat(self._bit(masks, lang), bounds[some]).astype(float)
                out[some, lang] = np.clip((hits / total[some] - self.chance[lang]) / max(1e-9, 1 - self.chance[lang]), 0, 1)
        return out


def _gram_counts(batches):
    """Per task: counts of the n-grams of each language's sample."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for i, j, data, off in blocks(batch.column("text")):
            gram, row = ngrams(data, off)
            bounds = row_bounds(row, j - i)
            for lang in set(langs[i:j]):
                own = np.concatenate([gram[bounds[k] : bounds[k + 1]] for k in range(j - i) if langs[i + k] == lang])
                old = total.get(lang, (np.empty(0, np.uint64), np.empty(0, np.int64)))
                new, n = np.unique(own, return_counts=True)
                both, where = np.unique(np.concatenate([old[0], new]), return_inverse=True)
                total[lang] = both, np.bincount(where, np.concatenate([old[1], n])).astype(np.int64)
    for lang, (gram, n) in total.items():
        for at in range(0, len(gram), 100_000):
            part = slice(at, at + 100_000)
            yield pa.record_batch({"lang": pa.array([lang] * len(gram[part])), "gram": pa.array(gram[part].view(np.int64)), "n": pa.array(n[part])})


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageFilters:
    """Filters from the labelled rows outside the held-out fold.

    Each language is sampled by a hash of the id to about ``FIT_DOCS`` rows, so
    that what reaches the driver is bounded by the n-grams of that sample.
    """
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageFilters([], [], [])
    share = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, FIT_DOCS / sizes[lang])))])
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("langid")), F.lit(1_000_000)) / 1_000_000
    sample = known.filter(place < share[F.col("lang")]).select("lang", "text")
    counted = sample.mapInArrow(_gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)
    found = counted.toArrow()
    lang, gram, n = found["lang"].to_numpy(zero_copy_only=False), found["gram"].to_numpy().view(np.uint64), found["n"].to_numpy().astype(float)
    rate, top_gram, at = np.zeros(len(n)), *np.unique(gram, return_inverse=True)
    for x in languages:
        own = lang == x
        rate[own] = n[own] / max(1.0, n[own].sum())
    top = np.zeros(len(top_gram))
    np.maximum.at(top, at, rate)
    typical = rate * MAX_RATIO >= top[at]
    return LanguageFilters(languages, [gram[(lang == x) & typical] for x in languages], [sizes[x] for x in languages])


def predictor(filters: LanguageFilters, spark):
    """A column function: text -> struct<lang_pred string, score double, rejected boolean>."""
    shared = spark.sparkContext.broadcast(vars(filters))

    @F.arrow_udf("struct<lang_pred: string, score: double, rejected: boolean>")
    def predict(text: pa.Array) -> pa.Array:
        model = LanguageFilters.__new__(LanguageFilters)
        vars(model).update(shared.value)
        preds: list[str] = []
        scores: list[float] = []
        rejected: list[bool] = []
        for i, j, data, off in blocks(text):
            gram, row = ngrams(data, off)
            share = model.shares(gram, row, j - i)
            n_grams = np.bincount(row, minlength=j - i)
            letter = np.zeros(j - i, bool)
            some = np.flatnonzero(np.diff(off))
            if len(some):
                ascii_letter = np.isin(data | 32, np.arange(97, 123, dtype=np.uint8)) & (data < 128)
                letter[some] = np.logical_or.reduceat(ascii_letter, off[some])
            for k in range(j - i):
                if not letter[k]:
                    letter[k] = any(c.isalpha() for c in (text[i + k].as_py() or ""))
                if not letter[k] or not model.languages:
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                best = int(np.argmax(share[k]))
                if share[k, best] <= 0:
                    best = model.likeliest
                preds.append(model.languages[best])
                scores.append(float(share[k, best]))
                rejected.append(bool(n_grams[k] >= REJECT_GRAMS and share[k, best] < REJECT_SHARE))
        return pa.StructArray.from_arrays([pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["lang_pred", "score", "rejected"])

    return predict


def identify(docs: DataFrame, filters: LanguageFilters | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, rejected.

    ``lang_pred`` is ``und`` with score 0 if the text is null or has no letter,
    or if no language could be learned.  A text whose n-grams no language has
    gets the most frequent language with score 0.  Of languages with equal
    shares the first in code-point order wins.  Null ids belong to no fold.
    Other columns are not read.
    """
    filters = filters or fit(docs, id_col, text_col)
    predict = predictor(filters, docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p")).select("doc_id", "held_out", "p.*")


def in_some_language(docs: DataFrame, filters: LanguageFilters | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with their columns."""
    filters = filters or fit(docs, id_col, text_col)
    return docs.filter(~predictor(filters, docs.sparkSession)(F.col(text_col))["rejected"])
