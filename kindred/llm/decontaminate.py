"""Benchmark decontamination: passages within a small edit distance of a benchmark item.

The CGK embedding walks along a sequence of words and writes one symbol per step; whether the walk
moves on after a step depends on the step and the symbol alone. Two sequences a few edits apart walk
in step again soon after an edit, so their embeddings differ in few places: edit distance becomes
Hamming distance. A key is made of the embedding at a few sampled steps, and several samples are
drawn, so that windows of an item meet windows of a copy in one of them with high probability. For
every length of an item the window and the number of samples are those that meet ``TARGET`` of copies
with all the edits that are allowed, as counted on random words, for words put in, left out or replaced.
What meets is verified by the exact edit distance.

Windows are made where a copy can lie at all. Up to k edits cut an item of n words into k + 1 runs at
most, which keep n - k words: one run of (n - k) / (k + 1) words stays as it is. So places further than
n + k words from every run of that length of some item hold no copy, and nothing is lost without them.

Items are taken in blocks of bounded size, whose keys every task holds; texts never move.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from kindred.llm.buffers import WORD_BYTE, add_columns, blocks, fresh_name, hashes, mix, per_row, spans, utf8

SAMPLED = 6  # embedding steps in a key
SAMPLES = 24  # keys per window at most
WINDOWS = (4, 8, 16)  # words
CHOICES = ((16, 4), (8, 4), (8, 8), (4, 4), (4, 8), (8, 16), (4, 16), (8, 24), (4, 24))  # (window, samples), the fewest chance meetings first
TARGET = 0.98  # of the copies with as many edits as are allowed
TRIALS = 400
LONG = 128  # words; longer items have more windows, and are met by what such items are met by
SHORT = 4  # items of up to so many words are met by all their words, somewhat longer ones by halves too
STRETCH = 1.5  # embedding steps per word of a window
LONGEST_RUN = 4  # words; longer runs that stay as they are contain such a one
BLOCK_BYTES = 4 << 20
SEED = 17


def _schedule():
    """For every window size and sample the steps it takes, in order."""
    rng = np.random.default_rng(SEED)
    plan = {}
    for size in WINDOWS:
        steps = int(size * STRETCH)
        plan[size] = [np.sort(rng.choice(steps, min(SAMPLED, steps - 2), replace=False)) for _ in range(SAMPLES)]
    return plan


PLAN = _schedule()


def cgk_keys(
    words: np.ndarray, wanted: tuple[tuple[int, int], ...], places: np.ndarray | None = None
) -> dict[tuple[int, int], np.ndarray]:
    """Keys of the window at every one of ``places``, all by default: (window size, sample) to an array, for
    each size its number of samples. Word 0 ends a text; a walk that gets there stays."""
    bits = mix(words ^ np.uint64(0x5851F42D4C957F2D + SEED))
    bits[words == 0] = 0
    at = np.arange(len(words)) if places is None else places
    keys = {(size, k): np.full(len(at), size * 64 + k + 1, np.uint64) for size, samples in wanted for k in range(samples)}
    for step in range(int(max((size for size, _ in wanted), default=0) * STRETCH)):
        symbol = words[at]
        for (size, k), key in keys.items():
            if step in PLAN[size][k]:
                key *= np.uint64(0x9E3779B97F4A7C15)
                key ^= symbol
        at = at + ((bits[at] >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
    return {name: mix(key) for name, key in keys.items()}


def _starts(words: int, size: int) -> np.ndarray:
    """Where an item's windows begin. A walk covers about three quarters of its window, so the last
    windows may reach past the end."""
    return np.arange(words - size // 2)


SIGNS = {"left out": -1, "replaced": 0, "put in": 1}  # by how much an edit changes the length


def _edited(text: np.ndarray, at: np.ndarray, kind: str, rng) -> np.ndarray:
    """Copies of the rows of ``text`` (each ends with 0), one after the other, with an edit at the places ``at``."""
    marked = np.zeros(text.shape, bool)
    np.put_along_axis(marked, at, True, 1)
    if kind == "left out":
        return text[~marked]
    new = rng.integers(1, 1 << 62, marked.sum()).astype(np.uint64)
    if kind == "replaced":
        copy = text.copy()
        copy[marked] = new
        return copy.ravel()
    return np.insert(text.ravel(), np.flatnonzero(marked), new)


def _recall(words: int, edits: int, size: int, samples: int, spread: bool, kind: str) -> float:
    """The share of items of random words that share a key with a copy after ``edits`` edits of a kind, evenly
    spread or at random places, in a text that goes on behind it."""
    rng = np.random.default_rng(SEED)
    text = rng.integers(1, 1 << 62, (TRIALS, words + 1)).astype(np.uint64)
    text[:, -1] = 0
    if spread:
        at = ((np.arange(edits) + rng.random((TRIALS, 1))) * words / max(edits, 1)).astype(np.int64)
    else:
        at = np.argsort(rng.random((TRIALS, words)), 1)[:, :edits]
    rows = _edited(text, at, kind, rng).reshape(TRIALS, -1)
    after = rng.integers(1, 1 << 62, (TRIALS, max(WINDOWS))).astype(np.uint64)
    copies = np.concatenate([rows[:, :-1], after, rows[:, -1:]], axis=1).ravel()
    ours = cgk_keys(text.ravel(), ((size, samples),))
    theirs = cgk_keys(copies, ((size, samples),))
    met, inside = np.zeros(TRIALS, bool), copies != 0
    for name, key in ours.items():
        met |= np.isin(key.reshape(text.shape)[:, _starts(words, size)], theirs[name][inside]).any(1)
    return met.mean()


@lru_cache(maxsize=None)
def choose(words: int, edits: int) -> tuple[int, int]:
    """(window size, samples) for an item of so many words and allowed edits: the first of ``CHOICES``
    whose window fits twice and meets ``TARGET``; where none does, the one that meets most."""
    if words > LONG:
        return choose(LONG, -(-edits * LONG // words))
    best = (-1.0, WINDOWS[0], SAMPLES)
    for size, samples in CHOICES:
        if 2 * size <= words or size == WINDOWS[0]:
            recall = 1.0
            for kind, spread in ((k, s) for s in (True, False) for k in SIGNS):
                recall = min(recall, _recall(words, edits, size, samples, spread, kind))
                if recall < TARGET:
                    break
            if recall >= TARGET:
                return size, samples
            best = max(best, (recall, size, samples))
    return best[1:]


def run_keys(words: np.ndarray, size: int) -> np.ndarray:
    """Keys of the ``size`` words from every place on; those that reach past a text's end match nothing."""
    key = np.full(len(words), size, np.uint64)
    for i in range(size):
        moved = np.zeros(len(words), np.uint64)
        moved[: len(words) - i] = words[i:]
        key = mix(key ^ moved)
    return key


def edit_distance_within(item: list[int], text: list[int]) -> tuple[int, int]:
    """The least edit distance between ``item`` and any run of ``text``, and the first end of such a
    run; columns of the distance table are bits of two integers."""
    m = len(item)
    ones, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[int, int] = {}
    for i, word in enumerate(item):
        where[word] = where.get(word, 0) | (1 << i)
    more, less, score, best, end = ones, 0, m, m, 0
    for j, word in enumerate(text):
        equal = where.get(word, 0)
        down = equal | less
        right = (((equal & more) + more) ^ more) | equal
        plus, minus = less | (ones & ~(right | more)), more & right
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1) & ones, (minus << 1) & ones
        more, less = minus | (ones & ~(down | plus)), plus & down
        if score < best:
            best, end = score, j + 1
    return best, end


@dataclass(frozen=True)
class Index:
    """The keys of a block of items, sorted, with the item and the place each key begins at."""

    ids: tuple[int, ...]
    words: tuple[tuple[int, ...], ...]
    most: tuple[int, ...]
    sizes: tuple[tuple[int, int], ...]  # window sizes, and the most samples that an item asks for
    short: tuple[int, ...]
    key: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    runs: tuple[tuple[int, int, np.ndarray, np.ndarray], ...]  # words, how far a copy reaches, keys, seen


def split_words(column: pa.Array) -> list[np.ndarray]:
    data, offsets = utf8(column)
    starts, ends = spans(data, offsets, WORD_BYTE)
    return np.split(hashes(data, starts, ends) | np.uint64(1), per_row(starts, offsets)[1:-1])


def _allowed(words: int, similarity: float) -> int:
    return int((1 - similarity) * words + 1e-9)


def _unedited(words: int, edits: int) -> int:
    """Words of the longest run that so many edits leave as it is, up to ``LONGEST_RUN``."""
    return min(LONGEST_RUN, max(1, -(-(words - edits) // (edits + 1))))


def _seen(keys: np.ndarray) -> np.ndarray:
    """A table over the last bits of the keys: which of them occur."""
    table = np.zeros(1 << max(16, int(np.ceil(np.log2(len(keys) * 16 + 1)))), bool)
    table[keys & np.uint64(len(table) - 1)] = True
    return table


def _kept_runs(words: list[np.ndarray], most: tuple[int, ...]) -> tuple:
    """Per length of a run that must have stayed as it is: the runs of the items that it holds for."""
    keys, reach = {}, {}
    for own, edits in zip(words, most):
        if len(own):
            n = _unedited(len(own), edits)
            keys.setdefault(n, []).append(run_keys(own, n)[: len(own) - n + 1])
            reach[n] = max(reach.get(n, 0), len(own) + edits)
    return tuple((n, reach[n], (found := np.unique(np.concatenate(keys[n]))), _seen(found)) for n in sorted(keys))


def _reachable(index: Index, words: np.ndarray) -> np.ndarray:
    """The places within reach of a run of an item that may have stayed as it is: no copy lies elsewhere."""
    edge = np.zeros(len(words) + 1, np.int64)
    for n, reach, keys, seen in index.runs:
        made = run_keys(words, n)
        maybe = np.flatnonzero(seen[made & np.uint64(len(seen) - 1)])
        near = np.searchsorted(keys, made[maybe])
        maybe = maybe[keys[np.minimum(near, len(keys) - 1)] == made[maybe]]
        np.add.at(edge, np.maximum(maybe - reach, 0), 1)
        np.add.at(edge, np.minimum(maybe + reach + 1, len(words)), -1)
    return np.flatnonzero((np.cumsum(edge[:-1]) > 0) & (words != 0))


def choices(items: tuple[tuple[int, str], ...], similarity: float) -> tuple[tuple[int, tuple[int, int]], ...]:
    """(words, (window size, samples)) for the lengths of the items that are met by windows."""
    lengths = {len(w) for w in split_words(pa.array([t for _, t in items], pa.string()))} if items else set()
    return tuple((n, choose(n, _allowed(n, similarity))) for n in sorted(lengths) if n > SHORT)


@lru_cache(maxsize=2)
def build_index(items: tuple[tuple[int, str], ...], similarity: float, chosen: tuple = ()) -> Index:
    """Built once per worker process. ``chosen``: what ``choices`` gave for the items, so that workers
    need not count again."""
    chosen = dict(chosen)
    ids = tuple(i for i, _ in items)
    words = split_words(pa.array([t for _, t in items], pa.string())) if items else []
    keys, item, place = [], [], []

    def put(key, k, places):
        keys.append(key[places])
        item.append(np.full(len(places), k))
        place.append(places)

    most = tuple(_allowed(len(w), similarity) for w in words)
    sizes, short = {}, set()
    for k, own in enumerate(words):
        n = len(own)
        if not n:
            continue
        if n <= SHORT:
            short.add(n)
            put(run_keys(own, n), k, np.zeros(1, np.int64))
            continue
        if n < 2 * WINDOWS[0]:  # one edit at most: it leaves one half of the item as it is
            for half in {n // 2, n - n // 2}:
                short.add(half)
                put(run_keys(own, half), k, np.array([0, n - half]))
        size, samples = chosen.get(n) or choose(n, most[k])
        sizes[size] = max(samples, sizes.get(size, 0))
        for key in cgk_keys(np.append(own, np.uint64(0)), ((size, samples),)).values():
            put(key, k, _starts(n, size))
    empty = np.zeros(0, np.int64)
    key, item, place = (np.concatenate(x) if x else empty for x in (keys, item, place))
    key = key.astype(np.uint64)
    order = np.lexsort((place, item, key))
    return Index(
        ids, tuple(tuple(w.tolist()) for w in words), most, tuple(sorted(sizes.items())), tuple(sorted(short)),
        key[order], item[order], place[order], _seen(key), _kept_runs(words, most),
    )


def _hits(index: Index, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, item, place in the item) of all windows that share a key."""
    places, entries = [], []
    near = _reachable(index, words)
    made = list(cgk_keys(words, index.sizes, near).values()) if len(near) else []
    made += [run_keys(words, n)[near] for n in index.short] if len(near) else []
    for key in made:
        maybe = np.flatnonzero(index.seen[key & np.uint64(len(index.seen) - 1)])
        low = np.searchsorted(index.key, key[maybe], "left")
        n = np.searchsorted(index.key, key[maybe], "right") - low
        places.append(np.repeat(near[maybe], n))
        entries.append(np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    if not places:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    entry = np.concatenate(entries)
    return np.concatenate(places), index.item[entry], index.place[entry]


def _verified(index: Index, words: np.ndarray, begins: np.ndarray, places, items, within) -> dict[tuple[int, int], tuple]:
    """The nearest run of each text for each item that it meets: (distance, start, end)."""
    rows = np.searchsorted(begins, places, "right") - 1
    diagonal = places - within
    found: dict[tuple[int, int], tuple] = {}
    if not len(places):
        return found
    spread = np.array(index.most)
    order = np.lexsort((diagonal, items, rows))
    rows, items, diagonal = rows[order], items[order], diagonal[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (items[1:] != items[:-1]) | (diagonal[1:] - diagonal[:-1] > spread[items[1:]] + 1)
    firsts = np.flatnonzero(new)
    for a, b in zip(firsts, np.append(firsts[1:], len(rows)), strict=True):
        row, k = int(rows[a]), int(items[a])
        if found.get((row, k), (1,))[0] == 0:
            continue
        item, most = index.words[k], index.most[k]
        low = max(int(begins[row]), int(diagonal[a]) - 2 * most)
        high = min(int(begins[row + 1]) - 1, int(diagonal[b - 1]) + len(item) + 2 * most)
        region = words[low:high]
        # Each edit takes away one of the item's words at most.
        if np.isin(np.array(item, np.uint64), region).sum() < len(item) - most:
            continue
        text = region.tolist()
        distance, end = edit_distance_within(list(item), text)
        if distance > most:
            continue
        _, back = edit_distance_within(list(item)[::-1], text[:end][::-1])
        best = (distance, low + end - back - int(begins[row]), low + end - int(begins[row]))
        if (row, k) not in found or best < found[row, k]:
            found[row, k] = best
    return found


MATCH = StructType([
    StructField("item_id", LongType()), StructField("distance", LongType()), StructField("similarity", DoubleType()),
    StructField("start", LongType()), StructField("end", LongType()),
])
_MATCHES = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("distance", pa.int64()), ("similarity", pa.float64()), ("start", pa.int64()), ("end", pa.int64()),
]))


def find_in_column(column: pa.Array, index: Index) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(len(column))]
    for low, high, data, offsets in blocks(column):
        starts, ends = spans(data, offsets, WORD_BYTE)
        first = per_row(starts, offsets)
        # A zero ends every text, so that no window runs into the next one.
        words = np.insert(hashes(data, starts, ends) | np.uint64(1), first[1:], np.uint64(0))
        begins = first + np.arange(len(first))
        for (row, k), (distance, start, end) in sorted(_verified(index, words, begins, *_hits(index, words)).items()):
            out[low + row].append({
                "item_id": index.ids[k], "distance": distance, "similarity": 1 - distance / len(index.words[k]),
                "start": start, "end": end,
            })
    return out


def find_items(
    docs: DataFrame,
    items: DataFrame,
    similarity: float = 0.8,
    item_id: str = "item_id",
    item_text: str = "text",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``matches``: an array of (item_id, distance, similarity, start, end), one per item
    that a run of the text's words comes near to, by item.

    Words are runs of ASCII letters, digits and characters beyond ASCII, in either case. Similarity is
    1 - edit distance in words / words of the item; the nearest run is given, by word numbers from 0.
    A null or empty text, or item, and an item with a null id match nothing; items that share an id are
    matched one by one. Rows are compared one by one: repeated rows repeat, an empty table stays empty,
    and a column named ``matches`` is replaced. Items are read in blocks of about ``BLOCK_BYTES``.
    """
    source = items.select(items[f"`{item_id}`"].cast("long").alias("id"), items[f"`{item_text}`"].alias("text")).dropna()
    size = source.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    parts = int(size // BLOCK_BYTES) + 1
    result, order = docs, docs.columns if keep is None else keep
    names = []
    for part in range(parts):
        mine = source.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part) if parts > 1 else source
        block = tuple(sorted((r["id"], r["text"]) for r in mine.collect()))
        # One block at a time is in the driver's memory; a broadcast lies in a file until tasks fetch it.
        shared = docs.sparkSession.sparkContext.broadcast((block, choices(block, similarity)))
        del block
        name = fresh_name(result.columns, f"matches_{part}")

        def compute(column, shared=shared):
            held, chosen = shared.value
            return [pa.array(find_in_column(column, build_index(held, similarity, chosen)), _MATCHES)]

        kept = [text, *[c for c in order if c not in (text, "matches")], *names] if part < parts - 1 else [
            *[c for c in order if c != "matches"], *names
        ]
        result = add_columns(result, text, [StructField(name, ArrayType(MATCH))], compute, kept)
        names.append(name)
    return result.select(
        *[F.col(f"`{c}`") for c in order if c != "matches"], F.array_sort(F.flatten(F.array(*names))).alias("matches")
    )
