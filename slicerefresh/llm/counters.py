"""Corpus counts in arrays of a fixed size.

Every task counts its texts into one array; the arrays are added up piece by
piece in the shuffle, so that no task and no result is larger than the array,
however long the corpus is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PIECE_BITS = 14


def summed(df: DataFrame, count, bits: int) -> np.ndarray:
    """Sum over all rows of what ``count(batch) -> array of 2**bits`` gives for each Arrow batch."""
    piece_bits = min(PIECE_BITS, bits)
    n_pieces = 1 << (bits - piece_bits)
    columns = "piece long, counts binary"

    def pieces(batches):
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            total += count(batch)
        for k, piece in enumerate(total.reshape(n_pieces, -1)):
            if piece.any():
                yield pa.record_batch({"piece": pa.array([k], pa.int64()), "counts": pa.array([piece.astype("<u4").tobytes() if piece.max() < 1 << 32 else piece.astype("<u8").tobytes()], pa.binary())})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                more = np.frombuffer(raw, "<u4" if len(raw) == 4 << piece_bits else "<u8").astype(np.int64)
                sums[k] = sums[k] + more if k in sums else more
        if sums:
            yield pa.record_batch({"piece": pa.array(list(sums), pa.int64()), "counts": pa.array([s.astype("<u8").tobytes() for s in sums.values()], pa.binary())})

    out = np.zeros((n_pieces, 1 << piece_bits), np.int64)
    for r in df.mapInArrow(pieces, columns).repartition(n_pieces, "piece").mapInArrow(add, columns).collect():
        out[r["piece"]] = np.frombuffer(r["counts"], "<u8")
    return out.ravel()
