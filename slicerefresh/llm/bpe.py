"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding.

The vocabulary file is of the kind with lower case, words and word ends
(``word_bpe_49k.json``): a text is put into NFC and lower case, cut into words
(contractions, runs of letters, single digits, runs of other signs; white space
goes), and each word's UTF-8 bytes are merged by the merge list.  The strings of
special tokens are special tokens.

**Lookahead.**  Merges are applied by rank.  A token ``t`` that stands at a
known left boundary fails to be there only if a token that ends where ``t``
ends merges with what follows.  Let ``E(t, r)`` be the number of symbols after
``t`` that can decide this before rank ``r``: a merge ``(s, z)`` of rank
``k < r``, ``s`` a right edge of ``t``, needs ``len(z) + E(z, k)`` of them.
The ranks fall along such a chain, so that one pass over the merge list in
order of rank gives all values (``lookahead``; 144 symbols at most for the
49k list).  A token whose end lies that far before the end of what has been
read is stable: no continuation changes it.  So a word of any length is
encoded in a buffer of a few thousand symbols.

**Streaming.**  ``Encoder.feed`` takes a text in pieces of any size and returns
the ids that are stable, ``finish`` the rest.  It holds back what a normal form,
a special token, a contraction or a merge may still change.  ``Decoder.feed``
takes ids and returns text: a state machine from bytes to characters, which
holds back the bytes of an unfinished character.  Memory does not grow with the
text, but for the memo of short words (``MEMO_WORDS`` entries, then cleared).
Short texts are taken together in blocks: their words are found and told apart in
arrays, and those that the memo does not hold are merged all at once, in each
step every word's merge of the least rank.

Defined results: null text and empty text have no ids and the decoded text ``""``;
null ids are kept as ids of rows; repeated rows are encoded each; extra columns
stay as they are, one named ``ids`` or ``decoded`` is replaced.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicerefresh.llm.text import list_array

#: Characters of a text that are taken at a time.
PIECE = 1 << 18
#: Symbols of a word that are merged at a time (several times any lookahead).
BLOCK = 4096
#: Words whose ids are remembered, and the longest such word.
MEMO_WORDS = 1 << 17
MEMO_LENGTH = 48
#: Words that are merged at a time, so that the arrays stay in the processor's cache.
MERGED = 1 << 14
#: Characters of short texts whose words are looked up together.
TOGETHER = 1 << 20

END = "</w>"
# --- Fixed values: the word pattern of the vocabulary file -------------------
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
# ---------------------------------------------------------------------------


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else the next from U+0100 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printing)]
    out = {b: chr(b) for b in printing} | {b: chr(0x100 + k) for k, b in enumerate(others)}
    return [out[b] for b in range(256)]


def _length(token: str) -> int:
    return len(token) - (len(END) if token.endswith(END) else 0)


def lookahead(merges: list[tuple[str, str]]) -> dict[str, int]:
    """Symbols after each token that can still undo it (see the module's text)."""
    after: dict[str, int] = {}
    for left, right in merges:
        of_right = after.get(right, 0)
        after[left] = max(after.get(left, 0), _length(right) + of_right)
        after[left + right] = max(after.get(left + right, 0), of_right)
    return after


def _ranges(chars: list[str]) -> str:
    """Sorted characters as the inside of a character class."""
    points, out = [ord(c) for c in chars], []
    start = 0
    for k in range(1, len(points) + 1):
        if k == len(points) or points[k] != points[k - 1] + 1:
            out.append((points[start], points[k - 1]))
            start = k
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


#: No merge, as a rank; kinds of characters.
_NEVER = 1 << 30
SPACE, LETTER, NUMBER, OTHER = range(4)


class Vocabulary:
    """What executors need of a vocabulary file; its size is that of the file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Regex, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.ids: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: k for k, pair in enumerate(merges)}
        self.after = {t: n for t, n in lookahead(merges).items() if n}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        # Which characters the file's pattern takes for letters, numbers and space:
        # asked of its library, whose Unicode version need not be Python's.
        everything = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        kinds = {}
        for name, cls in (("letter", r"\p{L}"), ("number", r"\p{N}"), ("space", r"\s")):
            found = pre_tokenizers.Split(Regex(f"[{cls}]+"), "removed", invert=True).pre_tokenize_str("".join(everything))
            kinds[name] = sorted(c for run, _ in found for c in run)
        self.kind = np.full(0x110000, OTHER, np.uint8)
        for name, number in (("letter", LETTER), ("number", NUMBER), ("space", SPACE)):
            self.kind[[ord(c) for c in kinds[name]]] = number
        low = {k: _ranges([c for c in v if c <= "￿"]) for k, v in kinds.items()}
        self.letters, self.others = f"[{low['letter']}]+", f"[^{low['space']}{low['letter']}{low['number']}]+"
        self.pattern = "|".join([*CONTRACTIONS, self.letters, f"[{low['number']}]", self.others])
        # Characters beyond U+FFFF are split as one of their kind below it.
        # The same merges for arrays: sorted pairs of ids, their ranks, and the id that each rank makes.
        pairs = np.array([self.ids[a] << 32 | self.ids[b] for a, b in merges], np.int64)
        self.by_pair = np.argsort(pairs, kind="stable")
        self.pairs = pairs[self.by_pair]
        self.makes = np.array([self.ids[a + b] for a, b in merges], np.int32)
        # Ids of single bytes, within a word and at its end, and the ranks of pairs of these.
        self.single = np.array([self.ids[c + end] for end in ("", END) for c in byte_symbols()], np.int32)
        self.first = np.full((256, 512), _NEVER, np.int32)
        place = {k: n for n, k in enumerate(self.single.tolist())}
        for k, (a, b) in enumerate(merges):
            left, right = place.get(self.ids[a], 256), place.get(self.ids[b])
            if left < 256 and right is not None:
                self.first[left, right] = k
        self.stand_in = {ord(c): s for kind, s in (("letter", "x"), ("number", "1"), ("space", " ")) for c in kinds[kind] if c > "￿"}
        self.path = path
        self.kept: Encoder | None = None

    def encoder(self) -> Encoder:
        """An encoder that stays with its words' ids for as long as a worker holds the vocabulary."""
        if self.kept is None:
            self.kept = Encoder(self)
        return self.kept


class _Memo(dict):
    """Ids of short words, forgotten when there are too many."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.encode(word)
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Merger:
    """Merges of whole words, and of long words block by block."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.symbol = byte_symbols()
        self.memo = _Memo(self.word)
        self.numbers = list(range(max(vocabulary.ids.values()) + 1))

    def learn(self, words: list[str]) -> None:
        """Put short words into the memo, merged all at once."""
        new = [w for w in words if w not in self.memo and len(w) <= MEMO_LENGTH]
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            new = [w for w in words if len(w) <= MEMO_LENGTH]
        for k in range(0, len(new), MERGED):
            self.memo.update(zip(new[k : k + MERGED], self.merged_words(new[k : k + MERGED]), strict=True))

    def merged_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of many words: in each step every word applies its merge of the least rank."""
        coded = [w.encode() for w in words]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        symbol = np.frombuffer(b"".join(coded), np.uint8).astype(np.int32)
        last = np.cumsum(size) - 1
        symbol[last] += 256
        t, name = self.v.single[symbol], np.arange(len(words))
        rank = np.full(len(t), _NEVER, np.int32)
        rank[:-1] = self.v.first[symbol[:-1] & 255, symbol[1:]]
        rank[last] = _NEVER
        tokens, sizes, names = [], [], []
        while len(name):
            least = np.minimum.reduceat(rank, np.cumsum(size) - size)
            open_ = least < _NEVER
            if not open_.all():  # words that are done leave
                stays = np.repeat(open_, size)
                tokens.append(t[~stays])
                sizes.append(size[~open_])
                names.append(name[~open_])
                t, rank, size, name, least = t[stays], rank[stays], size[open_], name[open_], least[open_]
                if not len(name):
                    break
            at = np.flatnonzero(rank == np.repeat(least, size))
            if len(at) > len(name):  # the same merge several times in a word: from the left, not overlapping
                fresh = np.append(True, np.diff(at) > 1)
                begin = np.flatnonzero(fresh)
                at = at[(np.arange(len(at)) - begin[np.cumsum(fresh) - 1]) % 2 == 0]
            t[at] = self.v.makes[rank[at]]
            stays = np.ones(len(t), bool)
            stays[at + 1] = False
            size = np.add.reduceat(stays, np.cumsum(size) - size, dtype=np.int64)
            t, rank = t[stays], rank[stays]
            at -= np.arange(len(at))
            near = np.zeros(len(t), bool)
            near[at] = near[np.maximum(at - 1, 0)] = True
            near[np.cumsum(size) - 1] = False
            rank[at] = _NEVER  # a word's last token begins no pair
            near = np.flatnonzero(near)
            rank[near] = self._ranks(t, near)
        size, name = np.concatenate(sizes), np.concatenate(names)
        # The same number objects in all words, so that the memo stays small.
        flat, end = list(map(self.numbers.__getitem__, np.concatenate(tokens).tolist())), np.cumsum(size)
        out: list[tuple[int, ...]] = [()] * len(words)
        for k, a, b in zip(name.tolist(), (end - size).tolist(), end.tolist()):
            out[k] = tuple(flat[a:b])
        return out

    def _ranks(self, t: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at ``at``."""
        key = t[at].astype(np.int64) << 32 | t[at + 1]
        found = np.minimum(np.searchsorted(self.v.pairs, key), len(self.v.pairs) - 1)
        return np.where(self.v.pairs[found] == key, self.v.by_pair[found], _NEVER)

    def symbols(self, word: str) -> list[str]:
        return [self.symbol[b] for b in word.encode("utf-8", "replace")]

    def word(self, word: str) -> tuple[int, ...]:
        symbols = self.symbols(word)
        if len(symbols) > BLOCK:
            stream = WordStream(self)
            return tuple(chain(stream.feed(symbols), stream.finish()))
        symbols[-1] += END
        ids = self.v.ids
        return tuple([ids[t] for t in self.merged(symbols)])

    def merged(self, symbols: list[str]) -> list[str]:
        return self._short(symbols) if len(symbols) <= 64 else self._long(symbols)

    def _short(self, parts: list[str]) -> list[str]:
        rank, none = self.v.rank, 1 << 60
        ranks = [rank.get(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank.get((parts[k - 1], parts[k]), none)
            if k < len(ranks):
                ranks[k] = rank.get((parts[k], parts[k + 1]), none)
        return parts

    def _long(self, parts: list[str]) -> list[str]:
        """The same by a heap of pairs over a linked list; stale entries are skipped."""
        rank, n = self.v.rank, len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, k, a, b) for k, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank.get((a, b))) is not None]
        heapq.heapify(heap)

        def push(k: int) -> None:
            j = after[k] if k >= 0 else -1
            if j >= 0 and (r := rank.get((parts[k], parts[j]))) is not None:
                heapq.heappush(heap, (r, k, parts[k], parts[j]))

        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k] if parts[k] == a else -1
            if j < 0 or parts[j] != b:
                continue
            parts[k], parts[j] = a + b, ""
            after[k] = after[j]
            if after[j] >= 0:
                before[after[j]] = k
            push(before[k])
            push(k)
        return [p for p in parts if p]


class WordStream:
    """One long word: symbols in, stable ids out."""

    def __init__(self, merger: Merger) -> None:
        self.merger, self.held = merger, []

    def feed(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for at in range(0, len(symbols), BLOCK):
            self.held += symbols[at : at + BLOCK]
            if len(self.held) > BLOCK:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        ids, after = self.merger.v.ids, self.merger.v.after
        known = len(self.held) - 1  # the last symbol may turn out to end the word
        out, at = [], 0
        for token in self.merger.merged(self.held[:known]):
            if at + len(token) + after.get(token, 0) > known:
                break
            out.append(ids[token])
            at += len(token)
        del self.held[:at]
        return out

    def finish(self) -> list[int]:
        self.held[-1] += END
        ids = self.merger.v.ids
        return [ids[t] for t in self.merger.merged(self.held)]


_NONE = np.empty(0, np.int32)


def _seconds() -> frozenset[str]:
    """Characters that may compose with the one before them without being marks."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0xA0, 0x20000))
    out = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
    return frozenset(out | {chr(c) for c in range(0x1161, 0x11C3)})


class Encoder:
    """Text in, stable ids out; one text after the other."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        v = self.v = vocabulary
        self.merger = Merger(v)
        self.find = re.compile(v.pattern)
        self.run_of = {"letter": re.compile(v.letters), "other": re.compile(v.others)}
        self.special = re.compile("(" + "|".join(map(re.escape, v.special)) + ")")
        self.longest = max(map(len, v.special))
        self.seconds: frozenset[str] | None = None
        self.library = None
        self.reset()

    def reset(self) -> None:
        self.raw = ""  # may hold the beginning of a special token or an unfinished normal form
        self.rest = ""  # normal text from the beginning of a word
        self.run: tuple[str, WordStream] | None = None  # a long word that goes on, and its kind

    # -- stages ---------------------------------------------------------------

    def feed(self, text: str, last: bool = False) -> list[int]:
        text = self.raw + text
        out: list[int] = []
        parts = self.special.split(text)
        for plain, special in zip(parts[:-1:2], parts[1::2]):
            out += self._normal(plain, True)
            out.append(self.v.special[special])
        tail = parts[-1]
        cut = len(tail) if last else self._safe(tail)
        self.raw = tail[cut:]
        return out + self._normal(tail[:cut], last)

    def finish(self) -> list[int]:
        out = self.feed("", True)
        self.reset()
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of one whole text."""
        if len(text) <= PIECE:
            out = self.feed(text, True)
        else:
            out = [*chain.from_iterable(self.feed(text[k : k + PIECE]) for k in range(0, len(text), PIECE)), *self.finish()]
        self.reset()
        return out

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of several whole texts; short ones are taken together."""
        out: list[np.ndarray] = [_NONE] * len(texts)
        held: list[int] = []
        size = 0
        for k, text in enumerate(texts):
            if len(text) > PIECE or self.special.search(text):
                out[k] = np.array(self.encode(text), np.int32)
                continue
            held.append(k)
            size += len(text)
            if size > TOGETHER:
                self._block(texts, held, out)
                held, size = [], 0
        self._block(texts, held, out)
        return out

    def _block(self, texts: list[str], held: list[int], out: list[np.ndarray]) -> None:
        words, per_text = self._found_words([self._normal_form(texts[k]) for k in held])
        if not len(words):
            return
        coded = words.dictionary_encode()
        different = coded.dictionary.to_pylist()
        self.merger.learn(different)
        ids = [self.merger.memo[w] for w in different]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        which = coded.indices.to_numpy()
        size = sizes[which]
        end = np.cumsum(size)
        place = np.repeat((np.cumsum(sizes) - sizes)[which] - (end - size), size) + np.arange(end[-1])
        stops = np.append(0, end)[np.append(0, np.cumsum(per_text))]
        every = flat[place]
        for k, a, b in zip(held, stops[:-1].tolist(), stops[1:].tolist()):
            out[k] = every[a:b]

    def _found_words(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Words of normal texts, one after the other, and how many each text has."""
        joined = "\n".join([*texts, "", ""])  # text ends and two characters to look ahead are space
        code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kind = self.v.kind[code]
        word = kind != SPACE
        begins = word.copy()
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        # Contractions begin where a run of other signs begins, and end within or with a run of letters.
        at = np.flatnonzero(begins & (code == ord("'")))
        a, b = code[at + 1], code[at + 2]
        for short in CONTRACTIONS:
            if len(short) == 2:
                here = at[a == ord(short[1])]
            else:
                here = at[(a == ord(short[1])) & (b == ord(short[2]))]
            begins[here + 1] = False
            after = here + len(short)
            begins[after[kind[after] == LETTER]] = True
        start = np.flatnonzero(begins)
        ends = np.cumsum([len(t) + 1 for t in texts])
        per_text = np.diff(np.searchsorted(start, np.append(0, ends)))
        data = np.frombuffer(joined.encode(), np.uint8)
        if len(data) == len(code):
            kept, place = data[word], np.cumsum(word, dtype=np.int32)
        else:
            length = 1 + (code >= 0x80).astype(np.int8) + (code >= 0x800) + (code >= 0x10000)
            kept, place = data[np.repeat(word, length)], np.cumsum(length * word, dtype=np.int32)
        offsets = np.append(np.append(0, place)[start], len(kept)).astype(np.int32)
        return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(kept)), per_text

    def _safe(self, text: str) -> int:
        """Where the text may be cut: no special token and no normal form goes across."""
        for k in range(len(text) - self.longest, 0, -1):
            c = text[k]
            if c < "\x80":
                return k
            if self.seconds is None:
                self.seconds = _seconds()
            if not unicodedata.combining(c) and c not in self.seconds and unicodedata.category(c) != "Cn":
                return k
        return 0

    def _normal(self, text: str, last: bool) -> list[int]:
        return self._words(self._normal_form(text), last)

    def _normal_form(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        if any(c > "ɏ" and unicodedata.category(c) == "Cn" for c in set(text)):  # newer than Python's tables
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.v.path).normalizer
            return self.library.normalize_str(text)
        text = unicodedata.normalize("NFC", text)
        # Each character by itself: Python's lower() has a rule for the last sigma of a word.
        return text.replace("Σ", "σ").lower()

    def _shaped(self, text: str) -> tuple[str, str]:
        """The text, and the same with characters beyond U+FFFF as one of their kind below it."""
        return text, text.translate(self.v.stand_in) if not text.isascii() and max(text) > "￿" else text

    def _words(self, text: str, last: bool) -> list[int]:
        text, shape = self._shaped(text)
        out: list[int] = []
        at = 0
        if self.run:
            kind, stream = self.run
            m = self.run_of[kind].match(shape)
            at = m.end() if m else 0
            out += stream.feed(self.merger.symbols(text[:at]))
            if at == len(shape) and not last:
                return out
            out += stream.finish()
            self.run = None
        if last and not self.rest:
            return out + self._found(text, shape, at)
        text, shape = self._shaped(self.rest + text[at:])
        if last:
            self.rest = ""
            return out + self._found(text, shape, 0)
        at = len(text)  # behind the last word is space at most
        for m in self.find.finditer(shape):
            if m.end() == len(shape) or m.start() > len(shape) - 3:  # may go on, or be the beginning of a contraction
                at = m.start()
                break
            out += self.merger.memo[text[m.start() : m.end()]]
        self.rest = text[at:]
        if len(self.rest) > BLOCK:  # one long run
            kind = "letter" if self.run_of["letter"].match(shape, at) else "other"
            stream = WordStream(self.merger)
            out += stream.feed(self.merger.symbols(self.rest))
            self.rest, self.run = "", (kind, stream)
        return out

    def _split(self, text: str, shape: str, at: int = 0) -> list[str]:
        if shape is text:
            return self.find.findall(text, at)
        return [text[m.start() : m.end()] for m in self.find.finditer(shape, at)]

    def _found(self, text: str, shape: str, at: int) -> list[int]:
        return list(chain.from_iterable(map(self.merger.memo.__getitem__, self._split(text, shape, at))))


class Decoder:
    """Ids in, text out: tokens with one space between, as a file without a decoder of its own has it.

    With ``plain`` the tokens' bytes are put together instead and a word's end
    becomes a space: the text itself, as far as the vocabulary keeps it.
    """

    def __init__(self, vocabulary: Vocabulary, plain: bool = False) -> None:
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.between = b"" if plain else b" "
        token_bytes: dict[int, bytes] = {}
        for token, k in vocabulary.ids.items():
            if plain:
                body, end = (token[: -len(END)], b" ") if token.endswith(END) else (token, b"")
                token_bytes[k] = bytes(byte_of[c] for c in body) + end
            else:
                token_bytes[k] = token.encode()
        token_bytes |= {k: token.encode() for token, k in vocabulary.special.items()}
        self.bytes = pa.array([token_bytes.get(k, b"") for k in range(max(token_bytes) + 1)], pa.binary())
        self.reset()

    def reset(self) -> None:
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids) -> str:
        if not len(ids):
            return ""
        found = self.bytes.take(pa.array(ids, pa.int32()))
        data = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found), self.between)[0].as_buffer()
        if self.begun and self.between:
            data = self.between + bytes(data)
        self.begun = True
        return self.state.decode(data)

    def finish(self) -> str:
        out = self.state.decode(b"", True)
        self.reset()
        return out

    def decode(self, ids) -> str:
        """Text of one row of ids."""
        return "".join([*(self.feed(ids[k : k + PIECE]) for k in range(0, len(ids), PIECE)), self.finish()])


#: Rows that are encoded and handed on at a time.
ROWS = 1000


def _replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.record_batch([*(batch.column(batch.schema.get_field_index(n)) for n in names), column], names=[*names, name])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != name), T.StructField(name, kind)])


_VOCABULARIES: dict[str, Vocabulary] = {}


def _shared(spark: SparkSession, path: str):
    """The vocabulary for the executors: a few MB, as large as its file."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return spark.sparkContext.broadcast(_VOCABULARIES[path])


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without their text, with ``ids``: the token ids of the whole text."""
    shared = _shared(docs.sparkSession, path)

    def run(batches):
        encoder = shared.value.encoder()
        for batch in batches:
            texts = batch.column(text_col)
            batch = batch.drop_columns([text_col])
            for at in range(0, len(texts), ROWS):
                rows = encoder.encode_many([t or "" for t in texts[at : at + ROWS].to_pylist()])
                column = list_array(np.cumsum([0, *map(len, rows)]), pa.array(np.concatenate(rows)))
                yield _replaced(batch.slice(at, len(rows)), "ids", column)

    return docs.mapInArrow(run, _schema(docs.drop(text_col), "ids", T.ArrayType(T.IntegerType())))


def decode(rows: DataFrame, path: str, ids_col: str = "ids", plain: bool = False) -> DataFrame:
    """``rows`` with ``decoded``: the text of their ids."""
    shared = _shared(rows.sparkSession, path)

    def run(batches):
        decoder = Decoder(shared.value, plain)
        for batch in batches:
            ids = batch.column(ids_col)
            flat, ends = ids.values.to_numpy(), ids.offsets.to_numpy().tolist()
            for k in range(0, len(ids), ROWS):
                at = ends[k : k + ROWS + 1]
                texts = [decoder.decode(flat[a:b]) for a, b in zip(at, at[1:])]
                yield _replaced(batch.slice(k, len(texts)), "decoded", pa.array(texts, pa.string()))

    return rows.mapInArrow(run, _schema(rows, "decoded", T.StringType()))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text, encoded and decoded again."""
    tokens = encode(docs.select("doc_id", "text"), path)
    both = decode(tokens, path)
    joined = F.array_join(F.transform("ids", lambda x: x.cast("string")), " ")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
