"""Quality rules: an isolation forest on the statistics that rules look at.

Plain rules reject what is too short or too repetitive. Beyond them, statistics of the text (shares
of symbols, capitals and punctuation, repeated lines and words, word lengths) make a point per
document: how far each lies beyond its usual range, in steps. Trees that split a sample of such points
at random places isolate unusual points early; the mean path length over the trees is the score, and
the score from which documents are rejected is set on the labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from kindred.llm.buffers import (
    CHAR_START, EXACT, NOT_SPACE, add_columns, blocks, counted, hashes, mix, per_row, spans,
)
from kindred.session import checkpoint

LEAST_WORDS, MOST_REPEATED = 50, 50  # the base rules: words, per cent of words in repeated windows
WINDOW = 3
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# A statistic's usual range ends at the first number, and it is as unusual as can be at the second.
# The steps keep ordinary documents at the same place, so that no split tells them apart.
RANGES = {
    "symbols": (0.02, 0.1), "capitals": (0.1, 0.4), "marks": (0.03, 0.1), "duplicate_lines": (0.3, 0.6),
    "repeats": (0.3, 0.5), "long_words": (7.0, 10.0), "short_words": (-3.0, -1.0),
}
STEPS = 8
SHARES = tuple(RANGES)
BINS = 1000


def _marked(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL = _marked("#*$%&|<>")
_CAPITAL = _marked("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_MARK = _marked("!?;:-_/\\=+~^@\"'()[]{}")
_NOT_BREAK = ~_marked("\n")
_WORD_CHAR = NOT_SPACE & CHAR_START


def measure(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(``STATISTICS``, ``SHARES``) of every text: integers, and how unusual each is, from 0 to 1."""
    counts = np.zeros((len(column), len(STATISTICS)), np.int64)
    shares = np.zeros((len(column), len(SHARES)))
    for low, high, data, offsets in blocks(column):
        starts, ends = spans(data, offsets, NOT_SPACE)
        first = per_row(starts, offsets)
        n = np.diff(first)
        rows = np.repeat(np.arange(high - low), n)
        words = hashes(data, starts, ends, EXACT)
        repeated = _repeated_words(words, rows, first)
        chars = counted(data, offsets, _WORD_CHAR)
        symbols = counted(data, offsets, _SYMBOL)
        lines, copies = _duplicate_lines(data, offsets, starts)
        counts[low:high] = np.column_stack([n, chars, symbols, copies, repeated])
        some, letters = np.maximum(n, 1), np.maximum(chars, 1)
        values = np.column_stack([
            symbols / letters, counted(data, offsets, _CAPITAL) / letters, counted(data, offsets, _MARK) / letters,
            copies / np.maximum(lines, 1), repeated / some, chars / some, -chars / some,
        ])
        begin, full = np.array(list(RANGES.values())).T
        shares[low:high] = np.floor(np.clip((values - begin) / (full - begin), 0, 1) * STEPS) / STEPS
    return counts, shares


def _repeated_words(words, rows, first):
    """Per row the words that lie in a window met twice or more."""
    texts = len(first) - 1
    if len(words) < WINDOW:
        return np.zeros(texts, np.int64)
    size = len(words) - WINDOW + 1
    code = mix(rows[:size].astype(np.uint64) + np.uint64(1))
    for i in range(WINDOW):
        code = mix(code ^ words[i : i + size])
    whole = np.flatnonzero(rows[:size] == rows[WINDOW - 1 :])
    _, inverse, times = np.unique(code[whole], return_inverse=True, return_counts=True)
    again = whole[times[inverse] > 1]
    covered = np.zeros(len(words), bool)
    for i in range(WINDOW):
        covered[again + i] = True
    return np.bincount(rows[covered], minlength=texts)


def _duplicate_lines(data, offsets, word_starts):
    """Per row its lines with a word, and those of them equal to an earlier one."""
    texts = len(offsets) - 1
    starts, ends = spans(data, offsets, _NOT_BREAK)
    filled = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends = starts[filled], ends[filled]
    rows = np.searchsorted(offsets, starts, "right") - 1
    _, at = np.unique(
        mix(hashes(data, starts, ends, EXACT) ^ mix(rows.astype(np.uint64) + np.uint64(1))), return_index=True
    )
    lines = np.bincount(rows, minlength=texts)
    return lines, lines - np.bincount(rows[at], minlength=texts)


def base_failed(counts: np.ndarray) -> np.ndarray:
    n, repeated = counts[:, 0], counts[:, 4]
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)


# --- the forest ---------------------------------------------------------------------------------


def _mean_path(n) -> np.ndarray:
    """Mean path length of a search that fails in a random tree of ``n`` points."""
    n = np.asarray(n, float)
    return np.where(n > 1, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), 0.0)


@dataclass(frozen=True)
class Forest:
    """Trees as arrays (tree, node): feature (-1 at a leaf), threshold, children and path length."""

    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    path: np.ndarray
    depth: int
    usual: float

    def score(self, points: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the higher, the sooner a point is isolated."""
        out = np.empty(len(points))
        trees = np.arange(len(self.feature))
        for low in range(0, len(points), 1024):
            x = points[low : low + 1024]
            node = np.zeros((len(x), len(trees)), np.int64)
            for _ in range(self.depth):
                feature = self.feature[trees, node]
                value = np.take_along_axis(x, np.maximum(feature, 0), 1)
                after = self.child[trees, node] + (value >= self.threshold[trees, node])
                node = np.where(feature < 0, node, after)
            out[low : low + 1024] = 2 ** (-self.path[trees, node].mean(1) / self.usual)
        return out


def grow_forest(sample: np.ndarray, trees: int, subsample: int, seed: int) -> Forest:
    """Trees over random subsamples; each split is at a random place of a random feature that varies."""
    size = min(subsample, len(sample))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    most = 2 ** (depth + 1)
    feature, child = np.full((trees, most), -1), np.zeros((trees, most), np.int64)
    threshold, path = np.zeros((trees, most)), np.zeros((trees, most))
    for t in range(trees):
        rng = np.random.default_rng([seed, t])
        nodes, todo = 1, [(0, sample[rng.choice(len(sample), size, replace=False)], 0)]
        while todo:
            node, points, level = todo.pop()
            low, high = points.min(0), points.max(0)
            varied = np.flatnonzero(high > low)
            if level == depth or not len(varied):
                path[t, node] = level + _mean_path(len(points))
                continue
            f = int(rng.choice(varied))
            cut = rng.uniform(low[f], high[f])
            right = points[:, f] >= cut
            if right.all():  # the cut fell on the lowest value
                cut = high[f]
                right = points[:, f] >= cut
            feature[t, node], threshold[t, node], child[t, node] = f, cut, nodes
            todo += [(nodes, points[~right], level + 1), (nodes + 1, points[right], level + 1)]
            nodes += 2
    return Forest(feature, threshold, child, path, depth, float(_mean_path(max(size, 2))))


@dataclass(frozen=True)
class Model:
    forest: Forest | None
    limit: float


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most_sample: int = 4000,
    trees: int = 200,
    subsample: int = 64,
    most_lost: float = 0.002,
    seed: int = 7,
) -> Model:
    """Grows the forest and sets its limit; both from labelled rows that pass the base rules.

    The forest is grown on at most ``most_sample`` of them, about as many as that with the smallest
    hashes. The limit is set on all of them: of the limits that reject at most ``most_lost`` of the
    good documents, the middle one of those that reject most of the bad ones. Without
    labelled rows that pass, or without bad ones among them, nothing beyond the base rules is
    rejected. Of several labels for an id the lowest counts; null ids and labels are left out.
    """
    fields = [StructField("failed", BooleanType()), *[StructField(s, DoubleType()) for s in SHARES]]

    def compute(column):
        counts, shares = measure(column)
        return [pa.array(base_failed(counts)), *[pa.array(shares[:, k]) for k in range(len(SHARES))]]

    marks = (
        labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{label}`"].cast("int").alias("good"))
        .dropna().groupBy("id").agg(F.min("good").alias("good"))
    )
    source = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text}`"].alias("text"))
    points = add_columns(source, "text", fields, compute, ["id"]).filter("NOT failed").join(marks, "id")
    points = checkpoint(points.select("id", "good", *SHARES))
    rows = points.count()
    if not rows:
        return Model(None, 1.0)
    chance = min(1.0, most_sample / rows)
    order = F.xxhash64("id", *SHARES)
    few = points.filter(F.pmod(order, F.lit(1 << 30)) < int(chance * (1 << 30)) + 1).orderBy(order).limit(most_sample)
    sample = np.array([[r[s] for s in SHARES] for r in few.collect()])
    if not len(sample):
        return Model(None, 1.0)
    forest = grow_forest(sample, trees, subsample, seed)

    def scored(batches):
        for batch in batches:
            x = np.column_stack([batch.column(k + 1).to_numpy(zero_copy_only=False) for k in range(len(SHARES))])
            bins = np.minimum((forest.score(x) * BINS).astype(np.int64), BINS - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bins)], names=["good", "bin"])

    tally = points.select("good", *SHARES).mapInArrow(scored, "good int, bin long").groupBy("good", "bin").count().collect()
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for row in tally:
        (good if row["good"] else bad)[row["bin"]] += row["count"]
    above_good, above_bad = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]
    allowed = np.flatnonzero(above_good <= most_lost * max(good.sum(), 1))
    most_bad = allowed[above_bad[allowed] == above_bad[allowed].max()]
    best = int(most_bad[len(most_bad) // 2])
    return Model(forest, best / BINS) if bad.sum() else Model(forest, 1.1)


RESULT = [
    *[StructField(s, LongType()) for s in STATISTICS], StructField("base_failed", BooleanType()),
    StructField("anomaly", DoubleType()), StructField("kept", BooleanType()),
]


def judge_quality(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, the ``anomaly`` score and ``kept``.

    ``kept`` is false where a base rule fails or the score reaches the model's limit. A null or empty
    text has no words, so it fails the base rules. Rows are judged one by one: repeated rows get the
    same verdict, an empty table stays empty, and columns with the new names are replaced. A very long
    text is measured whole, by itself: its memory grows with its length.
    """
    def compute(column):
        counts, shares = measure(column)
        failed = base_failed(counts)
        score = model.forest.score(shares) if model.forest else np.zeros(len(shares))
        kept = ~failed & (np.floor(score * BINS) < model.limit * BINS - 1e-9)
        return [*[pa.array(counts[:, k]) for k in range(len(STATISTICS))], pa.array(failed), pa.array(score), pa.array(kept)]

    return add_columns(docs, text, RESULT, compute, keep)
