import re

import pytest

from plain import base_spans, classes, distance, item_words, plain_print, plain_statistics

import corpus_pipeline
from kindred.llm.quality import fit_quality, judge_quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into and comes out of every stage, as lists of rows."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_return_the_columns_of_documents(stages):
    for name, (before, after) in stages.items():
        added = ["size", "source_size", "target", "taken"] if name == "mixing_sources" else []
        assert after.columns == before.columns + added


def test_the_mix_is_the_redacted_corpus(stages):
    before, after = stages["mixing_sources"]
    was = {r["doc_id"]: r for r in before.collect()}
    for r in after.collect():
        assert all(r[c] == was[r["doc_id"]][c] for c in before.columns)


def test_quality_rules(spark, stages):
    before, after = stages["quality_rules"]
    kept = texts(after)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    model = fit_quality(before, spark.read.parquet(f"{SF}/labels.parquet"))
    verdicts = {r["doc_id"]: r["kept"] for r in judge_quality(before, model, keep=["doc_id"]).collect()}
    for i, text in texts(before).items():
        n, *_, repeated = plain_statistics(text)
        failed = n < 50 or 100 * repeated > 50 * n
        assert (i in kept) == verdicts[i] and not (failed and i in kept)
        if i in labels and not failed:
            assert (i in kept) == bool(labels[i])


def test_near_duplicates(stages):
    before, after = stages["simhash_near_dedup"]
    prints = {i: plain_print(t) for i, t in texts(before).items()}
    groups = classes(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    want = {min(i for i, p in prints.items() if p in group) for group in map(set, groups)}
    assert set(texts(after)) == want


def test_decontamination(spark, stages):
    before, after = stages["benchmark_decontamination"]
    kept = set(texts(after))
    items = [item_words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, text in texts(before).items():
        own = item_words(text)
        have = set(own)
        # No edit distance within reach leaves so few of the item's words.
        near = [w for w in items if sum(x in have for x in w) >= 0.8 * len(w)]
        assert (i in kept) != any(distance(w, own) <= 0.2 * len(w) for w in near)


def test_secrets_are_gone_and_nothing_else(stages):
    before, after = stages["secret_scans"]
    was, now = texts(before), texts(after)
    assert set(was) == set(now) and any(base_spans(t) for t in was.values())
    for i, text in now.items():
        assert not base_spans(text)
        if not base_spans(was[i]):
            assert text == was[i]
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_mix(stages):
    before, after = stages["mixing_sources"]
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts(before).items()}
    rows = after.collect()
    assert len(rows) == len({r["doc_id"] for r in rows})
    per_source = {}
    for r in rows:
        assert sizes[r["doc_id"]] == r["size"] and 0 < r["taken"] <= 2 * r["size"]
        per_source.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert all(taken == round(target) for target, taken in per_source.values())
    assert abs(sum(t for t, _ in per_source.values()) - 1.5 * sum(sizes.values())) < 1


def test_run_is_the_stages_in_order(spark, stages):
    want = sorted(map(str, stages["mixing_sources"][1].collect()))
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == want
