import random

import numpy as np
import pyarrow as pa

from kindred.llm.buffers import EXACT, FOLDED, NOT_SPACE, blocks, counted, hashes, per_row, spans, utf8


def test_words_of_every_row_in_blocks_of_any_size():
    draw = random.Random(1)
    texts = ["".join(draw.choice("aB é\n\t日 ") for _ in range(draw.randint(0, 30))) for _ in range(500)] + [None, ""]
    for most in (1, 7, 100, 1 << 20):
        words = []
        for low, high, data, offsets in blocks(pa.array(texts), most):
            starts, ends = spans(data, offsets, NOT_SPACE)
            first = per_row(starts, offsets)
            for row in range(high - low):
                words.append([bytes(data[s:e]) for s, e in zip(starts[first[row]:first[row + 1]], ends[first[row]:first[row + 1]])])
        assert words == [(t or "").encode().split() for t in texts]


def test_equal_words_have_equal_hashes_and_others_do_not():
    texts = ["abc abd ABC a", "abc", "a\0 a", "日本 日"]
    data, offsets = utf8(pa.array(texts))
    starts, ends = spans(data, offsets, NOT_SPACE)
    words = [bytes(data[s:e]) for s, e in zip(starts, ends)]
    for values, same in ((EXACT, lambda w: w), (FOLDED, bytes.lower)):
        got = hashes(data, starts, ends, values)
        for a, x in zip(got, words):
            for b, y in zip(got, words):
                assert (a == b) == (same(x) == same(y))


def test_slices_and_nulls():
    column = pa.array(["x", None, "yé", "", "z"]).slice(1, 3)
    data, offsets = utf8(column)
    assert bytes(data) == "yé".encode() and offsets.tolist() == [0, 0, 3, 3]
    assert counted(data, offsets, np.ones(256, bool)).tolist() == [0, 3, 0]
    assert list(blocks(pa.array([], pa.string()))) == []
