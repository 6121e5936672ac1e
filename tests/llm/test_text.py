import numpy as np
import plain
import pyarrow as pa

from slicerefresh.llm import text as op

TEXTS = ["Hello  World\n\tfoo", "", None, "été\u00a0x y", " ", "a", "one two three four five six", "x" * 3000 + " y", "\x0b\x0ca b\r"]


def test_words_and_shingles_match_plain():
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["skip", *TEXTS], kind).slice(1)
        for limit in (1, 50, 1 << 20):
            seen = {}
            for i, j, data, off in op.blocks(column, limit):
                start, end, row = op.words(data, off)
                h, h_row, _ = op.shingle_hashes(op.word_hashes(data, start, end), row, 4, j - i)
                for k in range(i, j):
                    own = [bytes(op.LOWER_ASCII[data[a:b]]).decode() for a, b, r in zip(start, end, row) if r == k - i]
                    assert own == plain.words(TEXTS[k])
                    seen[k] = h[h_row == k - i].tolist()
            assert sorted(seen) == list(range(len(TEXTS)))
            for k, hashes in seen.items():
                assert len(hashes) == len(plain.shingles(plain.words(TEXTS[k]), 4))


def test_hashes_depend_on_bytes_only():
    data = np.frombuffer(b"abcabcabd" * 50, np.uint8)
    prefix = op.prefix_hash(data)
    by = {}
    for a in range(0, len(data) - 12):
        for n in (1, 3, 12):
            h = int(op.range_hash(prefix, np.array([a]), np.array([a + n]))[0])
            assert by.setdefault(bytes(data[a : a + n]), h) == h
    assert len(set(by.values())) == len(by)
