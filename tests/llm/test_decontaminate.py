import random

import numpy as np
import pyarrow as pa
import pytest
from plain import distance, item_words as words

from kindred.llm import decontaminate
from kindred.llm.decontaminate import build_index, edit_distance_within, find_in_column, find_items


def test_edit_distance_of_the_nearest_run():
    draw = random.Random(14)
    for _ in range(1500):
        item = [draw.randint(1, 5) for _ in range(draw.randint(1, 70))]
        text = [draw.randint(1, 5) for _ in range(draw.randint(0, 90))]
        best, end = edit_distance_within(item, text)
        assert best == distance(item, text)
        assert min(distance(item, text[:end]), len(item)) == best


@pytest.fixture(scope="module")
def benchmark():
    import duckdb

    return tuple(duckdb.connect().execute("SELECT item_id, text FROM '/root/testdata/sf0.01/benchmark.parquet' ORDER BY 1").fetchall())


def edited(draw, text, share, vocabulary):
    parts = text.split()
    for at in draw.sample(range(len(parts)), int(share * len(parts))):
        kind = draw.random()
        parts[at] = draw.choice(vocabulary) if kind < 0.5 else "" if kind < 0.75 else f"{parts[at]} {draw.choice(vocabulary)}"
    return " ".join(parts)


def test_recall_of_edited_passages_and_no_false_match(benchmark):
    draw = random.Random(15)
    vocabulary = [w for _, t in benchmark for w in t.split()]
    index = build_index(benchmark, 0.8)
    for share, least in ((0, 1.0), (0.1, 0.99), (0.2, 0.95)):
        texts, meant = [], []
        for item_id, text in benchmark * 3:
            around = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 60))) for _ in range(2)]
            texts.append(f"{around[0]} {edited(draw, text, share, vocabulary)} {around[1]}")
            meant.append((item_id, words(text)))
        met = near = 0
        for text, (item_id, item), matches in zip(texts, meant, find_in_column(pa.array(texts), index), strict=True):
            if distance(item, words(text)) <= 0.2 * len(item):
                near += 1
                met += item_id in {m["item_id"] for m in matches}
            for m in matches:
                other = words(dict(benchmark)[m["item_id"]])
                assert m["distance"] == distance(other, words(text)) == distance(other, words(text)[m["start"] : m["end"]])
                assert m["distance"] <= 0.2 * len(other)
        assert near > 100 and met >= least * near


def test_short_items_and_awkward_rows(spark):
    items = spark.createDataFrame(
        [(1, "alpha"), (2, "two words"), (3, "one two three four"), (4, "a b c d e f"), (5, None), (6, ""), (None, "alpha"), (7, "ALPHA!")],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [(i, t, "m") for i, t in (
            (1, "x Alpha y"), (1, "x Alpha y"), (2, "two-words"), (3, "one two three"), (4, None), (5, ""),
            (None, "one, two three four"), (6, "z a b c x d e f z"), (7, "a b c d e f"),
        )],
        "doc_id long, text string, matches string",
    )
    got = sorted(((r["doc_id"] or 0, [(m["item_id"], m["distance"], m["start"], m["end"]) for m in r["matches"]]) for r in find_items(docs, items).collect()))
    assert got == [
        (0, [(3, 0, 0, 4)]), (1, [(1, 0, 1, 2), (7, 0, 1, 2)]), (1, [(1, 0, 1, 2), (7, 0, 1, 2)]), (2, [(2, 0, 0, 2)]), (3, []),
        (4, []), (5, []), (6, [(4, 1, 1, 8)]), (7, [(4, 0, 0, 6)]),
    ]
    assert find_items(docs, items.limit(0)).filter("size(matches) > 0").count() == 0
    assert find_items(docs.limit(0), items).collect() == []


def test_items_in_several_blocks_give_the_same(spark, benchmark, monkeypatch):
    items = spark.createDataFrame(list(benchmark), "item_id long, text string")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300)
    whole = sorted(map(str, find_items(docs, items, keep=["doc_id"]).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 3000)
    assert sorted(map(str, find_items(docs, items, keep=["doc_id"]).collect())) == whole


def test_exact_passages_of_the_table_are_all_found(spark, benchmark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.createDataFrame(list(benchmark), "item_id long, text string")
    got = {r["doc_id"]: {m["item_id"] for m in r["matches"]} for r in find_items(docs, items).collect()}
    for r in docs.collect():
        text = " " + " ".join(words(r["text"])) + " "
        assert {i for i, t in benchmark if " " + " ".join(words(t)) + " " in text} <= got[r["doc_id"]]


@pytest.mark.parametrize("n", [9, 10, 15, 16, 17, 19, 20, 24, 31, 32, 36, 40, 48, 63, 64, 100, 150])
@pytest.mark.parametrize("kind", ["left out", "replaced", "put in", "mixed"])
def test_recall_at_each_length_with_evenly_spread_edits(n, kind):
    draw = random.Random(n)
    edits = int(0.2 * n + 1e-9)
    items = tuple((i, " ".join(f"w{draw.randrange(10**9)}" for _ in range(n))) for i in range(300))
    texts = []
    for _, text in items:
        parts, shift = text.split(), draw.random()
        places = {int((k + shift) * n / edits) for k in range(edits)}
        assert len(places) == edits
        copy = [f"y{draw.randrange(10**9)}" for _ in range(7)]
        for k, part in enumerate(parts):
            edit = (draw.choice(["left out", "replaced", "put in"]) if kind == "mixed" else kind) if k in places else None
            copy += {None: [part], "left out": [], "replaced": ["x"], "put in": [f"z{draw.randrange(10**9)}", part]}[edit]
        texts.append(" ".join(copy + ["end"] * 5))
    found = find_in_column(pa.array(texts), build_index(items, 0.8))
    assert sum(i in {m["item_id"] for m in matches} for (i, _), matches in zip(items, found, strict=True)) >= 0.95 * len(items)


def test_no_copy_lies_out_of_reach():
    """Places that are passed over hold no run within the allowed distance: checked at every place by the table
    of distances, on few words so that many runs come near."""
    from kindred.llm.decontaminate import _reachable, split_words

    draw = random.Random(4)
    for similarity in (0.5, 0.8, 1.0):
        pool = [f"w{i}" for i in range(30)]
        items = tuple((i, " ".join(draw.choice(pool) for _ in range(draw.randint(1, 25)))) for i in range(12))
        index = build_index(items, similarity)
        for _ in range(12):
            parts = [draw.choice(pool) for _ in range(40)]
            _, source = draw.choice(items)
            copy = [w for w in source.split() if draw.random() > 0.15]
            parts[20:20] = copy
            own = np.append(split_words(pa.array([" ".join(parts)]))[0], np.uint64(0))
            near = set(_reachable(index, own).tolist())
            for item, most in zip(index.words, index.most):
                for low in range(len(parts)):
                    for high in range(low + 1, min(len(parts), low + len(item) + most) + 1):
                        if abs(high - low - len(item)) <= most and whole_distance(list(item), own[low:high].tolist()) <= most:
                            assert set(range(low, high)) <= near


def whole_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]
