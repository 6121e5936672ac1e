"""Tokens are whole 64-bit hashes."""

import numpy as np

from slicerefresh.llm import jaccard as op


def test_hashes_alike_in_48_bits_stay_apart():
    order = np.zeros(1 << op.SKETCH_BITS, np.uint16)
    order[5] = 9
    h = np.array([(7 << 32) + 5, (7 << 32) + 6, (7 << 32) + 9, (7 << 32) + 6], np.uint64)
    assert op._ordered(h, order).tolist() == [(7 << 32) + 6, (7 << 32) + 9, (7 << 32) + 5]
