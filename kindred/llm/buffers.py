"""Text columns as byte arrays: blocks of rows, word spans and word hashes, all in numpy.

Spark hands a task Arrow batches, whose string column already is one UTF-8 buffer with offsets. The
operators of this package read that buffer in blocks of about a megabyte, so that what a task holds
is bounded by the block or the longest text, not by the partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 4096
SEGMENT_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
WORD_BYTE = np.zeros(256, bool)  # digits, ASCII letters, and every byte of a character beyond ASCII
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    WORD_BYTE[_first : _last + 1] = True
CHAR_START = (np.arange(256) & 0xC0) != 0x80


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(fold_case: bool) -> np.ndarray:
    codes = np.arange(256)
    if fold_case:
        codes = np.where((codes >= 0x41) & (codes <= 0x5A), codes + 32, codes)
    return mix((codes + 1).astype(np.uint64) * np.uint64(_BASE))


EXACT, FOLDED = _byte_values(False), _byte_values(True)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= SEGMENT_BYTES:
            _powers[name] = have
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null reads as empty."""
    flat = (pc.fill_null(column, "") if column.null_count else column).cast(pa.large_binary())
    _, offsets, data = flat.buffers()
    at = np.frombuffer(offsets, np.int64)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
    if data is None or not at[-1] - at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(flat) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def blocks(
    column: pa.Array, most_bytes: int = BLOCK_BYTES, most_rows: int = BLOCK_ROWS
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of successive blocks; a longer text is alone."""
    data, offsets = utf8(column)
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + most_bytes, "right")) - 1
        high = max(low + 1, min(high, low + most_rows, rows))
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of bytes marked in ``inside``; none crosses a row."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    within = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = within[:-1]
    starts = np.flatnonzero(within & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = within[1:]
    return starts, np.flatnonzero(within & (~after | edge[1:])) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = FOLDED) -> np.ndarray:
    """A 64-bit hash of every span, equal for equal bytes (of either case, with ``FOLDED``)."""
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + SEGMENT_BYTES, "right")))
        first, last = int(starts[low]), int(ends[high - 1])
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(values[data[first:last]] * _power("up", _BASE, last - first), out=sums[1:])
        s, e = starts[low:high] - first, ends[low:high] - first
        out[low:high] = (sums[e] - sums[s]) * _power("down", pow(_BASE, -1, 1 << 64), last - first)[s]
        low = high
    return mix(out)


def counted(data: np.ndarray, offsets: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Number of marked bytes in each row."""
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(marked[data], out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def per_row(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the first span of each row, and their number at the end."""
    return np.searchsorted(starts, offsets)


def add_columns(
    docs: DataFrame,
    text: str | Column,
    fields: list[StructField],
    compute: Callable[[pa.Array], list[pa.Array]],
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows of ``docs`` with the columns that ``compute`` makes of the text (a column or its name).

    Only the texts go to Python. A column of ``docs`` that has the name of a new one (in either case)
    gives way to it. ``keep`` names the columns to keep; all, where it is None.
    """
    new = [f.name for f in fields]
    wanted = docs.columns if keep is None else keep
    passed = [docs[_quoted(c)] for c in wanted if c.lower() not in {n.lower() for n in new}]
    value = docs[_quoted(text)] if isinstance(text, str) else text

    def run(column: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(compute(column), names=new)

    # So marked, it runs once per text: no filter on its results is moved below it with a second copy.
    made, name = F.arrow_udf(run, StructType(fields)).asNondeterministic(), fresh_name(wanted, "made")
    whole = docs.select(*passed, made(value.cast("string")).alias(name))
    kept = [F.col(_quoted(c)) for c in whole.columns[:-1]]
    return whole.select(*kept, *[F.col(name)[n].alias(n) for n in new])


def fresh_name(taken: list[str], name: str) -> str:
    """``name``, lengthened until no column is called so."""
    lowered = {c.lower() for c in taken}
    while name in lowered:
        name += "_"
    return name


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
