"""Fill-in-the-middle texts by rotating blocks in place, and the way back.

A text is cut at two characters into prefix, middle and suffix. Sentinels go in front of the three, in
one byte array, and two neighbouring blocks change places by three reversals: each block, then both as
one. The same rotation with the lengths exchanged undoes it, so texts come back byte for byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from kindred.llm.buffers import CHAR_START, add_columns, blocks, fresh_name

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
DRAWS = 4  # numbers below 2**32 that decide about a text


def reverse(buffer: bytearray, low: int, high: int) -> None:
    """Reverse ``buffer[low:high]`` in place."""
    view = np.frombuffer(buffer, np.uint8)[low:high]
    half = len(view) // 2
    left = view[:half].copy()
    view[:half] = view[::-1][:half]
    view[len(view) - half :] = left[::-1]


def rotate(buffer: bytearray, low: int, cut: int, high: int) -> None:
    """Exchange the blocks ``buffer[low:cut]`` and ``buffer[cut:high]`` in place by three reversals."""
    reverse(buffer, low, cut)
    reverse(buffer, cut, high)
    reverse(buffer, low, high)


def insert(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text cut at two bytes, with its sentinels, in the order of ``form``."""
    buffer = bytearray(text)
    # From the last to the first, so that the cuts before stay where they are.
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[:0] = PREFIX
    middle, suffix = len(PREFIX) + first, len(PREFIX) + len(MIDDLE) + second
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return buffer


def restore(output: bytes, form: str) -> bytearray:
    """The text from which ``insert`` made ``output``; a plain one is the text itself."""
    buffer = bytearray(output)
    if form not in (PSM, SPM):
        return buffer
    # No text with a sentinel of its own was cut, so the first one found is the one put in.
    low = buffer.index(SUFFIX)
    cut = buffer.index(MIDDLE if form == PSM else PREFIX)
    rotate(buffer, low, cut, len(buffer))
    for mark in (PREFIX, MIDDLE, SUFFIX):
        at = buffer.index(mark)
        del buffer[at : at + len(mark)]
    return buffer


def draws(id_col: Column, seed: str = "1") -> Column:
    """An array of four numbers below 2**32 from the id: the first groups of eight hex digits of the
    sha256 of ``seed:id``. A null id reads as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    groups = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(DRAWS)]
    return F.array(*groups)


def _strings(parts: list[bytes | bytearray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(parts))]
    return pa.Array.from_buffers(pa.large_string(), len(parts), buffers).cast(pa.string())


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    seed: str = "1",
    cut_percent: int = 90,
    spm_percent: int = 20,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n`` (code points of the text), ``form`` (plain, psm or spm), ``prefix_chars``,
    ``middle_chars`` (null if plain) and ``output``.

    Of 100 texts ``cut_percent`` are cut, at two places drawn from the id, and of these ``spm_percent``
    become `<S>`suffix`<P>`prefix`<M>`middle, the others `<P>`prefix`<S>`suffix`<M>`middle. Texts that are
    empty or contain a sentinel stay plain: their output is the text.

    A null text is an empty one; null ids draw alike. Rows are handled one by one: those alike in id and
    text get the same result, an empty table stays empty, a task holds a batch or its longest text.
    Columns with the new names are replaced; ``keep`` names the others that stay, all where it is None.
    """
    def run(column: pa.Array, numbers: pa.Array) -> pa.Array:
        four = numbers.flatten().to_numpy(zero_copy_only=False).reshape(-1, DRAWS)
        n, prefix, middle = (np.zeros(len(column), np.int64) for _ in range(3))
        forms, outputs = [], []
        for low, high, data, offsets in blocks(column):
            for row in range(low, high):
                first, last = offsets[row - low], offsets[row - low + 1]
                mine = data[first:last]
                raw = mine.tobytes()
                starts = np.flatnonzero(CHAR_START[mine])
                n[row] = len(starts)
                h1, h2, h3, h4 = four[row].tolist()
                if not raw or h3 % 100 >= cut_percent or PREFIX in raw or SUFFIX in raw or MIDDLE in raw:
                    forms.append(PLAIN)
                    outputs.append(raw)
                    continue
                a, b = sorted((h1 % (len(starts) + 1), h2 % (len(starts) + 1)))
                cuts = [int(starts[c]) if c < len(starts) else len(raw) for c in (a, b)]
                forms.append(SPM if h4 % 100 < spm_percent else PSM)
                outputs.append(insert(raw, *cuts, forms[-1]))
                prefix[row], middle[row] = a, b - a
        plain = np.array([f == PLAIN for f in forms], bool)
        made = [
            pa.array(n), pa.array(forms, pa.string()), pa.array(prefix, mask=plain), pa.array(middle, mask=plain),
            _strings(outputs),
        ]
        return pa.StructArray.from_arrays(made, names=[f.name for f in fields])

    fields = [
        StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
        StructField("middle_chars", LongType()), StructField("output", StringType()),
    ]
    new = {f.name for f in fields}
    wanted = docs.columns if keep is None else keep
    passed = [docs[f"`{c.replace('`', '``')}`"] for c in wanted if c.lower() not in new]
    made, name = F.arrow_udf(run, StructType(fields)).asNondeterministic(), fresh_name(wanted, "made")
    value = docs[f"`{text}`"].cast("string")
    whole = docs.select(*passed, made(value, draws(docs[f"`{id_col}`"], seed)).alias(name))
    kept = [F.col(f"`{c.replace('`', '``')}`") for c in whole.columns[:-1]]
    return whole.select(*kept, *[F.col(name)[f.name].alias(f.name) for f in fields])


def restore_texts(
    made: DataFrame, output: str = "output", form: str = "form", keep: list[str] | None = None
) -> DataFrame:
    """``made`` with ``restored``, the exact text, from nothing but the output and its form.

    A null output is empty; one whose form is null or unknown is taken as plain. An output that lacks
    the sentinels of its form is an error: it was not made by ``fill_in_middle``.
    """
    def compute(column: pa.Array) -> list[pa.Array]:
        texts = []
        for low, high, data, offsets in blocks(column):
            for row in range(high - low):
                head, _, rest = data[offsets[row] : offsets[row + 1]].tobytes().partition(b":")
                texts.append(restore(rest, head.decode()))
        return [_strings(texts)]

    # The form goes along in front of the text, since one column is sent.
    known = F.when(F.col(form).isin(PSM, SPM), F.col(form)).otherwise(F.lit(PLAIN))
    value = F.concat(known, F.lit(":"), F.coalesce(F.col(output).cast("string"), F.lit("")))
    return add_columns(made, value, [StructField("restored", StringType())], compute, keep)
