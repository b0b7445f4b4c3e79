import random

import numpy as np
from plain import classes, plain_print

from kindred.llm.components import connected_components
from kindred.llm.simhash import _links, fingerprint, keep_first, near_duplicates, near_links


def test_fingerprints(spark):
    draw = random.Random(11)
    for text in ["", "a", "a b", "A b c", "é x y z w", "x " * 500] + [
        " ".join(draw.choice(["to", "be", "Or", "not"]) for _ in range(draw.randint(0, 40))) for _ in range(200)
    ]:
        assert fingerprint(text.encode()) == plain_print(text)
    sums = spark.createDataFrame([("a b c",)], "t string").selectExpr("xxhash64(t) h").first()["h"]
    assert fingerprint(b"a b c") == sums % (1 << 64)


def flip(draw, value, n):
    for b in draw.sample(range(64), n):
        value ^= 1 << b
    return value


def prints_near_each_other(draw, n):
    out = []
    for _ in range(n):
        out.append(draw.getrandbits(64) if draw.random() < 0.3 or not out else flip(draw, draw.choice(out), draw.choice([1, 2, 3, 3, 4, 5])))
    return sorted(set(out))


def test_links_connect_what_all_links_connect(spark):
    draw = random.Random(12)
    centre = draw.getrandbits(64)
    groups = prints_near_each_other(draw, 400) + [flip(draw, centre, draw.choice([1, 2, 3])) for _ in range(2500)]
    nodes = sorted(set(groups))
    table = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in nodes], "print long")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in near_links(table).collect()]
    assert len(edges) == len(set(edges)) and all((a ^ b).bit_count() <= 3 for a, b in edges)
    array = np.array(nodes, np.uint64)
    want = np.arange(len(nodes))
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 3
    while True:
        less = np.where(near, want[None, :], len(nodes)).min(1)
        if (less == want).all():
            break
        want = less
    roots = {r["node"] % (1 << 64): r["root"] for r in connected_components(
        spark.createDataFrame([tuple(int(np.uint64(x).view(np.int64)) for x in e) for e in edges], "a long, b long")
    ).collect()}
    got = [roots.get(x, x) for x in nodes]
    first = {}
    assert [first.setdefault(g, i) for i, g in enumerate(got)] == want.tolist()


def test_links_within_a_cell():
    draw = random.Random(13)
    for _ in range(50):
        nodes = prints_near_each_other(draw, 60)
        links = _links(np.array(nodes, np.uint64), 3)
        have = {frozenset((int(a), int(b))) for a, b in links}
        assert len(links) < len(nodes)
        assert classes(nodes, lambda a, b: frozenset((a, b)) in have) == classes(nodes, lambda a, b: (a ^ b).bit_count() <= 3)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == 61 + 50 + 2
    parts = {}
    for r in got:
        parts.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, parts.values())) == [2, 50, 61] and all(root in nodes for root, nodes in parts.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


TEXT = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen " * 4


def rows_with_copies():
    return [
        (5, TEXT, "x"), (3, TEXT, "y"), (9, TEXT.upper(), "z"), (None, TEXT, "n"), (1, "something else entirely here", "x"),
        (7, None, "x"), (8, "", "x"), (6, " \n", "x"), (2, "a b", "x"), (2, "a b", "x"), (2, "c d e f", "x"),
    ]


def test_near_duplicates_on_awkward_rows(spark):
    docs = spark.createDataFrame(rows_with_copies(), "doc_id long, text string, print string")
    got = sorted(((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in near_duplicates(docs).collect()))
    want = []
    for i, text, _ in rows_with_copies():
        mine = plain_print(text)
        ids = [j for j, other, _ in rows_with_copies() if j is not None and plain_print(other) == mine]
        want.append((i or -1, f"{mine:016x}", min(ids)))
    assert got == sorted(want)
    assert near_duplicates(docs.limit(0)).collect() == []


def test_one_of_each_group_stays_with_all_its_columns(spark):
    docs = spark.createDataFrame(rows_with_copies(), "doc_id long, text string, key string")
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    rows = sorted(((r["doc_id"], r["text"], r["key"]) for r in kept.collect()), key=str)
    assert rows == sorted([(3, TEXT, "y"), (1, "something else entirely here", "x"), (6, " \n", "x"), (2, "a b", "x"), (2, "c d e f", "x")], key=str)
