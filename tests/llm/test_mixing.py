import random
from collections import defaultdict

from kindred.llm.mixing import mix_sources


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, budget = set(), share * sum(sizes.values())
    while True:
        left = budget - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / total for s in order}
        above = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def test_targets_and_taken(spark):
    draw = random.Random(7)
    rows = []
    for i in range(900):
        source = draw.choice(["src1", "src10", "src2", None, "é", "zz", "src1", "src1"])
        rows.append((i if draw.random() > 0.02 else None, source, None if i % 50 == 0 else "w " * draw.randint(0, 60)))
    rows += [rows[5]] * 3 + [(901, "empty", " \n"), (902, "zz", "w " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = [r.asDict() for r in mix_sources(docs).collect()]
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for _, s, t in rows:
        sizes[s] -= len((t or "").split())
    assert not any(sizes.values())
    for r in got:
        sizes[r["source"]] = r["source_size"]
    want = plain_targets(dict(sizes))
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6
    for s, n in taken.items():
        assert n == round(want[s])
    again = mix_sources(docs.repartition(13)).collect()
    key = lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r)
    assert sorted(map(key, again)) == sorted(key(tuple(r.values())) for r in got)


def test_rows_without_an_id_are_in_many_ranges(spark):
    docs = spark.range(900).selectExpr("CAST(NULL AS LONG) AS doc_id", "'s' AS source", "concat('a b ', id) AS text", "id AS Size", "id AS n")
    rows = mix_sources(docs, keep=docs.columns).collect()
    assert sum(r["taken"] for r in rows) == 900 * 3 * 1.5 and sorted(r["n"] for r in rows) == [*range(900)]
    assert [c for c in rows[0].asDict()] == ["doc_id", "source", "text", "n", "size", "source_size", "target", "taken"]
    # Half are taken twice: not those that come first, as rows with one key and no order would be.
    twice = [r["n"] for r in rows if r["taken"] == 6]
    assert len(twice) == 450 and 350 < sum(twice) / 450 < 550
    again = mix_sources(docs.repartition(13), keep=["text"]).collect()
    assert {r["text"]: r["taken"] for r in again} == {r["text"]: r["taken"] for r in rows}


def test_empty_and_wordless_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mix_sources(docs).collect() == []
    docs = spark.createDataFrame([(1, "a", ""), (2, None, None)], docs.schema)
    assert sorted((r["doc_id"], r["target"], r["taken"]) for r in mix_sources(docs).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_one_large_source_is_in_many_tasks(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'s' AS source", "'a b c' AS text")
    plan = mix_sources(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [sum(size" in plan and "[source#" in plan and "range#" in plan
    got = mix_sources(docs).agg({"taken": "sum"}).first()[0]
    assert got == 18000
