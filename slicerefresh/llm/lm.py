"""Masked pseudo-likelihood scores by a bidirectional window network.

Every token of a text is predicted from the ``SIDE`` tokens before and after
it, and the logarithms of these conditional probabilities are summed over the
text.  The network's tokens are buckets of words; a fixed-size sketch of word
counts over the whole corpus names the frequent ones (``VOCABULARY`` less
``RARE``), all others are one of ``RARE`` classes by hash.

The probability of a word is that of its token times that of the word within
the token.  The latter comes from the counts of all words of the corpus, so the
vocabulary grows with the corpus: ``DISCOUNT`` is taken off each count and given
to words as they are spelled (each byte and the end one of 257), which is all
that a word never seen has.  The counts of the ``COMMON`` most frequent words at
most are broadcast, those of all others are joined.

The network adds an embedding per context position, applies tanh, and predicts
the token in two steps (its class, then the token within the class).  It is
trained in numpy, data-parallel: in each round every task starts from the same
parameters, goes once through its texts, and returns its parameters, which are
averaged by the number of tokens they have seen.  Round ``r`` trains on the
tokens at positions ``r`` modulo ``ROUNDS``, so that each token of the corpus is
learned from once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicerefresh.llm.counters import summed
from slicerefresh.llm.shared import written
from slicerefresh.llm.text import blocks, list_array, signed, word_hashes, words

SKETCH_BITS = 20
CLASSES, WITHIN = 32, 32
VOCABULARY, RARE = CLASSES * WITHIN, 64
SIDE, HIDDEN = 2, 24
ROUNDS, BATCH, RATE = 2, 8192, 0.5
_PAD = VOCABULARY
DISCOUNT = 0.5
COMMON = 1 << 20
#: Words that a task gathers before it counts them.
GATHER = 1 << 22


def vocabulary(docs: DataFrame) -> np.ndarray:
    """Token of every sketch bucket: the most counted buckets in order, then classes of rare ones."""

    def count(batch):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for _, _, data, off in blocks(batch.column("text")):
            start, end, _ = words(data, off)
            h = word_hashes(data, start, end)
            total += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
        return total

    counts = summed(docs.select("text"), count, SKETCH_BITS)
    named = np.argsort(-counts, kind="stable")[: VOCABULARY - RARE]
    token = (VOCABULARY - RARE + np.arange(1 << SKETCH_BITS) % RARE).astype(np.int16)
    token[named] = np.arange(len(named))
    return token


def tokens(data: np.ndarray, off: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a block and the row of each."""
    start, end, row = words(data, off)
    h = word_hashes(data, start, end)
    return names[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64), row


def windows(token: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The context of every token, ``len(token)`` by ``2 SIDE``; padding beyond the text's ends."""
    pad = np.full(SIDE, _PAD)
    wide, rows = np.concatenate([pad, token, pad]), np.concatenate([pad * 0 - 1, row, pad * 0 - 1])
    out = np.empty((len(token), 2 * SIDE), np.int64)
    for k, shift in enumerate([d for d in range(-SIDE, SIDE + 1) if d]):
        at = slice(SIDE + shift, SIDE + shift + len(token))
        out[:, k] = np.where(rows[at] == row, wide[at], _PAD)
    return out


class Network:
    """Parameters as one flat float32 vector with named views."""

    SHAPES = (("embed", (2 * SIDE, VOCABULARY + 1, HIDDEN)), ("bias", (HIDDEN,)), ("cls", (HIDDEN, CLASSES)), ("cls_bias", (CLASSES,)), ("word", (CLASSES, HIDDEN, WITHIN)), ("word_bias", (CLASSES, WITHIN)))

    def __init__(self, flat: np.ndarray | None = None) -> None:
        size = sum(int(np.prod(s)) for _, s in self.SHAPES)
        if flat is None:
            flat = np.random.default_rng(17).normal(0, 0.1, size)
        self.flat = np.array(flat, np.float32)
        at = 0
        for name, shape in self.SHAPES:
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n

    @staticmethod
    def _softmax(x: np.ndarray) -> np.ndarray:
        x = np.exp(x - x.max(axis=1, keepdims=True))
        x /= x.sum(axis=1, keepdims=True)
        return x

    def _forward(self, context: np.ndarray, token: np.ndarray):
        hidden = self.embed[0][context[:, 0]]
        for k in range(1, context.shape[1]):
            hidden += self.embed[k][context[:, k]]
        hidden += self.bias
        np.tanh(hidden, out=hidden)
        p_class = self._softmax(hidden @ self.cls + self.cls_bias)
        klass = token // WITHIN
        order = np.argsort(klass, kind="stable")
        bounds = np.searchsorted(klass[order], np.arange(CLASSES + 1))
        sorted_hidden = hidden[order]
        logits = np.empty((len(token), WITHIN), np.float32)
        for c in range(CLASSES):
            part = slice(bounds[c], bounds[c + 1])
            logits[part] = sorted_hidden[part] @ self.word[c] + self.word_bias[c]
        return hidden, p_class, klass, order, bounds, sorted_hidden, self._softmax(logits)

    def log_probability(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        _, p_class, klass, order, _, _, p_word = self._forward(context, token)
        at = np.arange(len(token))
        within = np.empty(len(token))
        within[order] = np.log(p_word[at, token[order] % WITHIN] + 1e-30)
        return np.log(p_class[at, klass] + 1e-30) + within

    def learn(self, context: np.ndarray, token: np.ndarray, moment: np.ndarray) -> None:
        """One AdaGrad step on a batch; ``moment`` holds the sums of squared gradients."""
        hidden, p_class, klass, order, bounds, sorted_hidden, p_word = self._forward(context, token)
        n, at = len(token), np.arange(len(token))
        grad = Network(np.zeros_like(self.flat))
        p_class[at, klass] -= 1
        p_word[at, token[order] % WITHIN] -= 1
        grad.cls[:] = hidden.T @ p_class
        grad.cls_bias[:] = p_class.sum(axis=0)
        back = p_class @ self.cls.T
        sorted_back = np.empty_like(sorted_hidden)
        for c in range(CLASSES):
            part = slice(bounds[c], bounds[c + 1])
            grad.word[c] = sorted_hidden[part].T @ p_word[part]
            grad.word_bias[c] = p_word[part].sum(axis=0)
            sorted_back[part] = p_word[part] @ self.word[c].T
        back[order] += sorted_back
        back *= 1 - hidden * hidden
        grad.bias[:] = back.sum(axis=0)
        for k in range(context.shape[1]):
            by = np.argsort(context[:, k], kind="stable")
            value = context[by, k]
            first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            grad.embed[k][value[first]] = np.add.reduceat(back[by], first, axis=0)
        grad.flat /= n
        moment += grad.flat * grad.flat
        self.flat -= RATE * 0.1 * grad.flat / (np.sqrt(moment) + 1e-6)


def _round(docs: DataFrame, names, flat: np.ndarray, number: int) -> np.ndarray:
    """Parameters after one pass over the positions of a round, averaged over the tasks."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(flat)
    pieces, columns = 16, "piece long, tokens long, values binary"

    def train(batches):
        net, seen = Network(shared.value), 0
        moment = np.full(len(net.flat), 1e-6, np.float32)
        for batch in batches:
            for _, _, data, off in blocks(batch.column("text")):
                token, row = tokens(data, off, names.value)
                if not len(token):
                    continue
                context = windows(token, row)
                first = np.searchsorted(row, row)
                mine = np.flatnonzero((np.arange(len(token)) - first) % ROUNDS == number)
                for at in range(0, len(mine), BATCH):
                    part = mine[at : at + BATCH]
                    net.learn(context[part], token[part], moment)
                seen += len(mine)
        if seen:
            for k, piece in enumerate(np.array_split(net.flat, pieces)):
                yield pa.record_batch({"piece": pa.array([k], pa.int64()), "tokens": pa.array([seen], pa.int64()), "values": pa.array([piece.tobytes()], pa.binary())})

    def average(batches):
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for k, n, raw in zip(*(batch.column(c).to_pylist() for c in ("piece", "tokens", "values")), strict=True):
                before, total = sums.get(k, (0, 0.0))
                sums[k] = before + n, total + n * np.frombuffer(raw, np.float32).astype(float)
        for k, (n, total) in sums.items():
            yield pa.record_batch({"piece": pa.array([k], pa.int64()), "tokens": pa.array([n], pa.int64()), "values": pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())})

    out = np.array_split(flat.copy(), pieces)
    for r in docs.select("text").mapInArrow(train, columns).repartition(pieces, "piece").mapInArrow(average, columns).collect():
        out[r["piece"]] = np.frombuffer(r["values"], np.float32)
    return np.concatenate(out)


def fit(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary and parameters from all texts of ``docs(text)``."""
    token_names = vocabulary(docs)
    names = docs.sparkSession.sparkContext.broadcast(token_names)
    flat = Network().flat
    for number in range(ROUNDS):
        flat = _round(docs, names, flat, number)
    return token_names, flat


def word_counts(docs: DataFrame, names: np.ndarray) -> DataFrame:
    """Every word of ``docs(text)`` by its hash, its token and how often it comes: word, token, n."""
    shared = docs.sparkSession.sparkContext.broadcast(names)

    def counted(gathered):
        word, n = np.unique(np.concatenate(gathered), return_counts=True)
        token = shared.value[(word >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
        return pa.record_batch({"word": pa.array(signed(word)), "token": pa.array(token.astype(np.int32)), "n": pa.array(n.astype(np.int64))})

    def count(batches):
        gathered, size = [], 0
        for batch in batches:
            for _, _, data, off in blocks(batch.column("text")):
                start, end, _ = words(data, off)
                gathered.append(word_hashes(data, start, end))
                size += len(start)
                if size >= GATHER:
                    yield counted(gathered)
                    gathered, size = [], 0
        if size:
            yield counted(gathered)

    return written(docs.select("text").mapInArrow(count, "word long, token int, n long").groupBy("word", "token").agg(F.sum("n").alias("n")), "lm-words")


class Within:
    """Log-probabilities of words within their tokens, as far as the broadcast counts tell."""

    def __init__(self, counts: DataFrame, names: np.ndarray) -> None:
        self.space = np.bincount(names, minlength=VOCABULARY) / len(names)
        self.total, self.distinct = np.zeros(VOCABULARY), np.zeros(VOCABULARY)
        for r in counts.groupBy("token").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
            self.total[r["token"]], self.distinct[r["token"]] = r["n"], r["words"]
        level = F.floor(F.log2("n") * 4).cast("int")
        sizes = sorted(((r["level"], r["words"]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()), reverse=True)
        upto = np.cumsum([n for _, n in sizes])
        fit = int(np.searchsorted(upto, COMMON, "right"))
        #: Whether all counted words are broadcast: then a word that is not has never been seen.
        self.complete = fit == len(sizes)
        common = counts.filter(level >= sizes[fit - 1][0] if fit else F.lit(False)).select("word", "n").toArrow()
        word = common["word"].to_numpy().view(np.uint64)
        order = np.argsort(word)
        self.word, self.n = word[order], common["n"].to_numpy()[order]

    def parts(self, word: np.ndarray, size: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log of the share of each word by its spelling, log of the total, and its broadcast count (0 if none)."""
        spelled = np.minimum(0.0, -(size + 1) * np.log(257) - np.log(np.maximum(self.space[token], 1e-12)))
        spelled += np.log(DISCOUNT * (self.distinct[token] + 1))
        n = np.zeros(len(word), np.int64)
        if len(self.word):
            at = np.minimum(np.searchsorted(self.word, word), len(self.word) - 1)
            n = np.where(self.word[at] == word, self.n[at], 0)
        return spelled, np.log(self.total[token] + DISCOUNT), n


def log_share(n: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    """Log of a word's part of its token: its count less the discount, and its spelling."""
    return np.where(n > 0, np.log(np.maximum(n - DISCOUNT, 1e-9) + np.exp(spelled)), spelled)


def pseudo_likelihood(
    docs: DataFrame, fitted: tuple[np.ndarray, np.ndarray] | None = None, id_col: str = "doc_id", text_col: str = "text", counts: DataFrame | None = None
) -> DataFrame:
    """One row per input row: doc_id, n_tokens, log_likelihood (summed), per_token (null without tokens).

    Null and empty texts have no tokens and sum 0.  Without any token in the
    corpus the network stays as it starts.  Repeated rows are learned from and
    scored each time.  Other columns are not read.  ``counts`` (of
    ``word_counts``) go with ``fitted``; a network given without them scores the
    tokens alone, not the words within them.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    context = docs.sparkSession.sparkContext
    if fitted is None:
        fitted = fit(rows)
        counts = word_counts(rows, fitted[0])
    within = Within(counts, fitted[0]) if counts is not None else None
    shared = context.broadcast((fitted, within))

    @F.arrow_udf("struct<n_tokens: bigint, log_likelihood: double, open: array<struct<word: bigint, spelled: double, times: int>>>")
    def score(text: pa.Array) -> pa.Array:
        (names, flat), within = shared.value
        net = Network(flat)
        n, total, n_open = np.zeros(len(text), np.int64), np.zeros(len(text)), np.zeros(len(text), np.int64)
        opened = [(np.empty(0, np.uint64), np.empty(0), np.empty(0, np.int64))]
        for i, j, data, off in blocks(text):
            start, end, row = words(data, off)
            if not len(start):
                continue
            h = word_hashes(data, start, end)
            token = names[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64)
            near = windows(token, row)
            logs = np.concatenate([net.log_probability(near[at : at + BATCH], token[at : at + BATCH]) for at in range(0, len(token), BATCH)])
            if within is not None:
                spelled, whole, count = within.parts(h, end - start, token)
                left = np.flatnonzero(count == 0) if not within.complete else np.empty(0, np.int64)
                share = log_share(count, spelled)
                share[left] = 0.0  # joined
                logs += share - whole
                order = left[np.lexsort((h[left], row[left]))]
                first = np.ones(len(order), bool)
                first[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
                first = np.flatnonzero(first)
                opened.append((h[order[first]], spelled[order[first]], np.diff(np.append(first, len(order)))))
                n_open[i:j] = np.bincount(row[order[first]], minlength=j - i)
            n[i:j] = np.bincount(row, minlength=j - i)
            total[i:j] = np.bincount(row, logs, minlength=j - i)
        word, spelled, times = (np.concatenate(x) for x in zip(*opened, strict=True))
        entries = pa.StructArray.from_arrays([pa.array(signed(word)), pa.array(spelled), pa.array(times, pa.int32())], ["word", "spelled", "times"])
        return pa.StructArray.from_arrays([pa.array(n), pa.array(total), list_array(np.concatenate([[0], np.cumsum(n_open)]), entries)], ["n_tokens", "log_likelihood", "open"])

    scored = rows.select("doc_id", score("text").alias("s")).select("doc_id", "s.*")
    if within is not None and not within.complete:
        scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")
        left = scored.select("row", F.inline("open")).join(counts.select("word", "n"), "word", "left")
        share = F.when(F.col("n").isNull(), F.col("spelled")).otherwise(F.log(F.col("n") - DISCOUNT + F.exp("spelled")))
        sums = left.groupBy("row").agg(F.sum(F.col("times") * share).alias("joined"))
        scored = scored.drop("open").join(sums, "row", "left").withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce("joined", F.lit(0.0)))
    scored = scored.select("doc_id", "n_tokens", "log_likelihood")
    return scored.withColumn("per_token", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
