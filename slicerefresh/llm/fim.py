"""Fill-in-the-middle examples over texts kept in seekable compressed frames.

A text is stored as zstandard frames of ``FRAME`` bytes that can be
decompressed one by one, each with the units and the code points before it
(``archive``).  Units are white space with the word behind it, or the white
space at a text's end.  ``transform`` draws two cuts from the document's id,
finds the frames they fall into by the cumulative counts and decompresses only
these; all other frames go into the output as they are, in another order, with
the markers as frames between them.  An output is again a list of frames, one
after the other a valid zstandard stream.  ``digests`` streams an output frame
by frame, and rebuilds the text from the output and its form: the markers are
found in the decompressed stream, the parts are read again in the text's order.
A task holds the frames of one batch of rows and one decompressed frame.

Defined results: a null text is empty; an empty text, one that holds a marker
and a document that is not drawn stay plain (null counts, the text as output);
a null id draws as the empty string does; repeated rows give equal results;
extra columns are kept, unless they have the name of one that is added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicerefresh.llm.shared import written
from slicerefresh.llm.text import blocks, list_array, row_bounds, words

#: Bytes of text in a frame, and the level of compression.
FRAME = 1 << 16
LEVEL = 3
#: Compressed bytes after which rows are handed on.
FLUSH_BYTES = 1 << 24

# --- Fixed values: markers, seed and rates of the transformation ---------------
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
# ---------------------------------------------------------------------------

#: Order of the parts in the text (0 prefix, 1 suffix, 2 middle) and in each form's output.
TEXT_ORDER = (0, 2, 1)
FORMS = {"psm": (0, 1, 2), "spm": (1, 0, 2)}
MARKERS = (PREFIX, SUFFIX, MIDDLE)

FRAMES = T.ArrayType(
    T.StructType(
        [
            T.StructField("units", T.LongType()),  # that end before the frame
            T.StructField("chars", T.LongType()),  # before the frame
            T.StructField("data", T.BinaryType()),
        ]
    )
)
_ARROW_FRAME = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())])
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def unit_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the units of one text, in bytes."""
    _, end, _ = words(data, np.array([0, len(data)]))
    return np.append(end, len(data)) if len(data) and _SPACE[data[-1]] else end


def frames_of(data: np.ndarray, ends: np.ndarray, compress) -> list[dict]:
    """The frames of a text whose units end at ``ends``."""
    out, at, chars = [], 0, 0
    while at < len(data):
        to = min(at + FRAME, len(data))
        while to < len(data) and data[to] & 0xC0 == 0x80:  # within a character
            to -= 1
        piece = data[at:to]
        out.append({"units": int(np.searchsorted(ends, at, "right")), "chars": chars, "data": compress(piece.tobytes())})
        chars += _chars(piece)
        at = to
    return out


def _with(schema: T.StructType, **added: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in schema.fields if f.name not in added), *(T.StructField(k, v) for k, v in added.items())])


def _batch(old: pa.RecordBatch, **added: pa.Array) -> pa.RecordBatch:
    names = [n for n in old.schema.names if n not in added]
    return pa.record_batch([*(old.column(old.schema.get_field_index(n)) for n in names), *added.values()], names=[*names, *added])


def archive(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``frames`` in place of the text, its units ``n`` and whether it is ``marked`` (holds a marker)."""

    def run(batches):
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            texts = batch.column(text_col)
            batch = batch.drop_columns([text_col])
            for i, j, data, off in blocks(texts):
                raw = data.tobytes()
                _, end, row = words(data, off)
                of = row_bounds(row, j - i)
                frames, bounds, n, marked = [], [0], [], []
                for k in range(j - i):
                    text = data[off[k] : off[k + 1]]
                    ends = end[of[k] : of[k + 1]] - off[k]
                    if len(text) and _SPACE[text[-1]]:
                        ends = np.append(ends, len(text))
                    frames += frames_of(text, ends, compress)
                    bounds.append(len(frames))
                    n.append(len(ends))
                    marked.append(any(raw.find(m, off[k], off[k + 1]) >= 0 for m in MARKERS))
                yield _batch(
                    batch.slice(i, j - i),
                    n=pa.array(n, pa.int64()),
                    marked=pa.array(marked),
                    frames=list_array(np.array(bounds), pa.array(frames, _ARROW_FRAME)),
                )

    schema = _with(docs.drop(text_col).schema, n=T.LongType(), marked=T.BooleanType(), frames=FRAMES)
    return docs.mapInArrow(run, schema)


def draws(doc_id: Column) -> list[Column]:
    """The first four groups of 8 hexadecimal digits of the id's SHA-256, as whole numbers."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _cut(frames: list[dict], unit: int, decompress) -> tuple[int, int, int]:
    """Frame, byte in it and code points of the text before the end of ``unit`` units."""
    k = int(np.searchsorted([f["units"] for f in frames], unit, "left")) - 1  # the last frame with fewer units before it
    if k < 0:
        return 0, 0, 0
    data = np.frombuffer(decompress(frames[k]["data"]), np.uint8)
    if k + 1 < len(frames):
        # A word at the frame's end ends here only if the next frame begins with space.
        ahead = np.frombuffer(decompress(frames[k + 1]["data"]), np.uint8)[:1]
        ends = unit_ends(np.append(data, ahead))
        ends = ends[ends <= len(data)]
    else:
        ends = unit_ends(data)
    at = int(ends[unit - frames[k]["units"] - 1])
    return k, at, frames[k]["chars"] + _chars(data[:at])


def arranged(frames: list[dict], form: str, low: int, high: int, compress, decompress) -> tuple[list[bytes], int, int]:
    """The output's frames, and the code points of prefix and middle."""
    a, a_at, a_chars = _cut(frames, low, decompress)
    b, b_at, b_chars = _cut(frames, high, decompress)
    cuts = [(0, 0), (a, a_at), (b, b_at), (len(frames), 0)]
    seen: dict[int, bytes] = {}  # at most the two frames that are cut

    def part(begin: tuple[int, int], end: tuple[int, int]) -> Iterator[bytes]:
        for k in range(begin[0], min(end[0] + 1, len(frames))):
            first, last = begin[1] if k == begin[0] else 0, end[1] if k == end[0] else None
            if first == 0 and last is None:
                yield frames[k]["data"]  # whole: as it is
            elif last != first:
                if k not in seen:
                    seen[k] = decompress(frames[k]["data"])
                if piece := seen[k][first:last]:
                    yield compress(piece)

    parts = [list(part(cuts[0], cuts[1])), list(part(cuts[2], cuts[3])), list(part(cuts[1], cuts[2]))]
    out = []
    for p in FORMS[form]:
        out += [compress(MARKERS[p]), *parts[p]]
    return out, a_chars, b_chars - a_chars


def transform(stored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Archived texts with ``form``, ``prefix_chars``, ``middle_chars`` and the frames of their ``output``."""
    h1, h2, h3, h4 = draws(F.col(id_col))
    plain = (F.col("n") == 0) | F.col("marked") | (h3 % 100 >= FIM_PERCENT)
    form = F.when(plain, "plain").when(h4 % 100 < SPM_PERCENT, "spm").otherwise("psm")
    cuts = [h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)]
    drawn = stored.withColumns({"form": form, "low": F.least(*cuts), "high": F.greatest(*cuts)})

    def run(batches):
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            frames, forms = batch.column("frames"), batch.column("form").to_pylist()
            low, high = batch.column("low").to_pylist(), batch.column("high").to_pylist()
            batch = batch.drop_columns(["frames", "low", "high"])
            begin, size, output, bounds, before, middle = 0, 0, [], [0], [], []
            for k, kind in enumerate(forms):
                stored_frames = frames[k].as_py()
                if kind == "plain":
                    made, n_before, n_middle = [f["data"] for f in stored_frames], None, None
                else:
                    made, n_before, n_middle = arranged(stored_frames, kind, low[k], high[k], compress, decompress)
                output += made
                size += sum(map(len, made))
                bounds.append(len(output))
                before.append(n_before)
                middle.append(n_middle)
                if size >= FLUSH_BYTES or k + 1 == len(forms):
                    yield _batch(
                        batch.slice(begin, k + 1 - begin),
                        prefix_chars=pa.array(before, pa.int64()),
                        middle_chars=pa.array(middle, pa.int64()),
                        output=list_array(np.array(bounds), pa.array(output, pa.binary())),
                    )
                    begin, size, output, bounds, before, middle = k + 1, 0, [], [0], [], []

    kept = drawn.drop("frames", "low", "high").schema
    schema = _with(kept, prefix_chars=T.LongType(), middle_chars=T.LongType(), output=T.ArrayType(T.BinaryType()))
    return drawn.mapInArrow(run, schema)


def _streamed(frames: list[bytes], decompress, begin: tuple[int, int] = (0, 0), end: tuple[int, int] | None = None) -> Iterator[bytes]:
    """Decompressed pieces from one place to another, a frame at a time."""
    for k in range(begin[0], len(frames) if end is None else min(end[0] + 1, len(frames))):
        data = decompress(frames[k])
        last = end[1] if end is not None and k == end[0] else None
        yield data[begin[1] if k == begin[0] else 0 : last]


def _marker(frames: list[bytes], marker: bytes, begin: tuple[int, int], decompress) -> tuple[tuple[int, int], tuple[int, int]]:
    """Places of the marker's first byte and of the byte behind it; it may lie across frames."""
    tail, places = b"", []  # the last bytes read and where each is
    for k in range(begin[0], len(frames)):
        data = decompress(frames[k])
        first = begin[1] if k == begin[0] else 0
        window = tail + data[first:]
        at = window.find(marker)
        if at >= 0:
            where = places + [(k, first + i) for i in range(min(len(data) - first, at + len(marker)))] if at < len(tail) else None
            start = where[at] if where else (k, first + at - len(tail))
            stop = first + at + len(marker) - len(tail)
            return start, (k, stop)
        places = [*places, *((k, i) for i in range(max(first, len(data) - len(marker) + 1), len(data)))][-(len(marker) - 1) :]
        tail = window[-(len(marker) - 1) :]
    raise ValueError(f"the output holds no {marker!r}")


def restored(frames: list[bytes], form: str, decompress) -> Iterator[bytes]:
    """The text behind an output, in pieces, from the output and its form alone."""
    if form == "plain":
        yield from _streamed(frames, decompress)
        return
    order = FORMS[form]
    begins, ends, at = {}, {}, (0, 0)
    for i, p in enumerate(order):
        start, at = _marker(frames, MARKERS[p], at, decompress)
        begins[p] = at
        if i:
            ends[order[i - 1]] = start
    for p in TEXT_ORDER:
        yield from _streamed(frames, decompress, begins[p], ends.get(p))


def digests(transformed: DataFrame) -> DataFrame:
    """Transformed texts with the SHA-256 of their output and of the text that is rebuilt from it."""

    def sha(pieces) -> str:
        h = hashlib.sha256()
        for p in pieces:
            h.update(p)
        return h.hexdigest()

    def run(batches):
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            outputs, forms = batch.column("output"), batch.column("form").to_pylist()
            made, again = [], []
            for k, form in enumerate(forms):
                frames = outputs[k].as_py()
                made.append(sha(_streamed(frames, decompress)))
                again.append(sha(restored(frames, form, decompress)))
            yield _batch(batch.drop_columns(["output"]), output_sha256=pa.array(made, pa.string()), restored_sha256=pa.array(again, pa.string()))

    schema = _with(transformed.drop("output").schema, output_sha256=T.StringType(), restored_sha256=T.StringType())
    return transformed.mapInArrow(run, schema)


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every text."""
    stored = written(archive(docs.select("doc_id", "text")), "fim-frames")
    return digests(transform(stored)).drop("marked")
