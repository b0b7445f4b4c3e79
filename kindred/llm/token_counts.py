"""Token counts by greedy longest match, in time linear in the text.

A word (a run without ASCII white space, with the word mark in front) is cut into the longest
pieces of a vocabulary, from left to right. The vocabulary is a trie over bytes. Where no longer
match is possible, the failure link of a node says where the match goes on once the pieces that are
certain by then are taken off; their number is stored with the link. Links and children together
make one transition array whose cells hold the next node and the pieces taken off on the way, so a
byte costs one look-up, and no piece is ever built.

Every byte is also a piece by itself, so that a character that the vocabulary lacks costs its bytes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from kindred.llm.buffers import NOT_SPACE, add_columns, blocks, per_row, spans

WORD_MARK = "▁"
FEW_WORDS = 8
_SHIFT, _LOW = 8, 255


def read_pieces(model_file: str) -> tuple[bytes, ...]:
    """The pieces of a sentencepiece model, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return tuple(
        model.id_to_piece(i).encode()
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    )


class Automaton:
    def __init__(self, pieces: tuple[bytes, ...], mark: bytes):
        """``pieces`` may hold any byte strings; the 256 single bytes are added."""
        children: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in {*pieces, *(bytes([b]) for b in range(256))}:
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    whole.append(False)
                node = children[node][byte]
            whole[node] = True
        whole[0] = False
        fail, taken = [0] * len(children), [0] * len(children)
        # next node << 8 | pieces taken off; filled level by level, as links lead to higher levels
        self.table = np.zeros((len(children), 256), np.int64)
        left = np.zeros(len(children), np.int64)  # pieces in what a node stands for
        for byte, child in children[0].items():
            self.table[0, byte] = child << _SHIFT
        level = list(children[0].values())
        for node in level:
            taken[node] = 1
        while level:
            now = np.array(level)
            links, counts = np.array([fail[n] for n in level]), np.array([taken[n] for n in level])
            self.table[now] = self.table[links] + counts[:, None]
            left[now] = counts + left[links]
            if left[now].max() >= _LOW:  # no step takes more pieces off than a node stands for, and one
                raise ValueError("the pieces of a prefix are too many for the transition array")
            below = []
            for node in level:
                for byte, child in children[node].items():
                    below.append(child)
                    if whole[child]:
                        fail[child], taken[child] = 0, 1
                    else:
                        step = int(self.table[fail[node], byte])
                        fail[child], taken[child] = step >> _SHIFT, taken[node] + (step & _LOW)
                    self.table[node, byte] = child << _SHIFT
            level = below
        if max(taken) > 127 or len(children) >= 1 << 23:
            raise ValueError("a piece is too long or the vocabulary too large for the transition array")
        self.table = self.table.astype(np.int32).ravel()
        self.left = left
        self.begin, self.begun = self.run(mark, 0, 0)

    def run(self, data: bytes, node: int, count: int) -> tuple[int, int]:
        for byte in data:
            step = int(self.table[node << 8 | byte])
            node, count = step >> _SHIFT, count + (step & _LOW)
        return node, count

    def lengths(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of pieces of each word; all words advance by one byte at a time."""
        sizes = ends - starts
        order = np.argsort(-sizes, kind="stable")
        at, sizes = starts[order], sizes[order]
        node = np.full(len(at), self.begin, np.int64)
        count = np.full(len(at), self.begun, np.int64)
        longer = np.searchsorted(-sizes, -np.arange(int(sizes[0]) + 1 if len(sizes) else 1), "left")
        for j in range(int(sizes[0]) if len(sizes) else 0):
            n = int(longer[j])
            if n <= FEW_WORDS:  # the few longest go on one by one
                for k in range(n):
                    rest = data[at[k] + j : at[k] + sizes[k]].tobytes()
                    node[k], count[k] = self.run(rest, int(node[k]), int(count[k]))
                break
            step = self.table[(node[:n] << 8) | data[at[:n] + j]]
            node[:n] = step >> _SHIFT
            count[:n] += step & _LOW
        out = np.empty(len(at), np.int64)
        out[order] = count + self.left[node]
        return out


@lru_cache(maxsize=2)
def automaton(pieces: tuple[bytes, ...], mark: bytes) -> Automaton:
    """Built once per worker process; only the pieces are sent."""
    return Automaton(pieces, mark)


def count_tokens(
    docs: DataFrame, pieces: tuple[bytes, ...], text: str = "text", mark: str = WORD_MARK, keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens``: words and greedy longest-match pieces of the text.

    A null or empty text has zero of both. Every row is counted by itself: repeated rows repeat, an
    empty table stays empty, and columns with the new names are replaced. A very long text is counted
    whole, by itself: its memory grows with its length.
    """
    def compute(column):
        ready = automaton(pieces, mark.encode())
        words, tokens = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
        for low, high, data, offsets in blocks(column):
            starts, ends = spans(data, offsets, NOT_SPACE)
            sums = np.concatenate([[0], np.cumsum(ready.lengths(data, starts, ends))])
            first = per_row(starts, offsets)
            words[low:high] = np.diff(first)
            tokens[low:high] = np.diff(sums[first])
        return [pa.array(words), pa.array(tokens)]

    fields = [StructField("n_words", LongType()), StructField("n_tokens", LongType())]
    return add_columns(docs, text, fields, compute, keep)
