"""Every operator and stage on nulls, empty and long texts, repeated rows, no rows, clashing columns."""

import pytest

import corpus_pipeline
from kindred.llm import (
    decontaminate, fill_in_middle, html_extract, language_id, licenses, masked_lm, mixing, quality, queries, secret_scan,
    simhash, token_counts, url_filter,
)

LONG = "word other thing " * 40_000
GOOD = "the quick brown fox jumps over the lazy dog and then it runs back home again because night has come to every one "
WHOLE_TEXT = GOOD + " ".join("".join(chr(97 + (i * j + j) % 26) for j in range(2, 7)) for i in range(26)) + " " + " ".join(
    "".join(chr(97 + (i * i * j + 1) % 26) for j in range(3, 7)) for i in range(13))
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, LONG, "en", "a", len(LONG)), (4, WHOLE_TEXT, "en", None, 1),
    (4, WHOLE_TEXT, "en", None, 1), (4, WHOLE_TEXT, "en", None, 2), (5, WHOLE_TEXT, "de", "b", 1), (None, GOOD, None, "b", 1),
    (6, " \n\t", "en", "a", 3), (7, "日本語 text é", "de", "", 9),
]
CLASHING = [
    "__text", "score", "Rejected", "lang_pred", "kept", "n_words", "matches", "secrets", "fingerprint", "key", "number",
    "print", "id", "size", "taken", "range", "first", "host", "path", "rule", "pos", "run", "hash", "label", "version",
    "Form", "output", "made",
]


def make(spark, rows=ROWS):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHING], "map('a', 1) AS `a map`")


def ids_of(rows):
    return sorted(str(r["doc_id"]) for r in rows)


def operators(spark):
    items = spark.createDataFrame([(1, "quick brown fox jumps over")], "item_id long, text string")
    labels = spark.createDataFrame([(4, 1), (5, 1), (3, 0)], "doc_id long, quality int")
    pieces = token_counts.read_pieces(queries.TOKENIZER)
    return {
        "masked_lm": lambda d: masked_lm.score_documents(d, masked_lm.train_masked_lm(d)),
        "language_id": lambda d: language_id.identify_language(d, language_id.learn_languages(d)),
        "url_filter": lambda d: url_filter.judge_urls(d, queries.URL_RULES, queries.BLOCKED_URLS, url="text"),
        "licenses": licenses.scan_licenses,
        "token_counts": lambda d: token_counts.count_tokens(d, pieces),
        "mixing": mixing.mix_sources,
        "simhash": simhash.near_duplicates,
        "quality": lambda d: quality.judge_quality(d, quality.fit_quality(d, labels)),
        "decontaminate": lambda d: decontaminate.find_items(d, items),
        "secret_scan": secret_scan.find_secrets,
        "fill_in_middle": fill_in_middle.fill_in_middle,
        "restore_texts": lambda d: fill_in_middle.restore_texts(fill_in_middle.fill_in_middle(d)),
        "html_extract": lambda d: html_extract.extract_main_text(d, html_extract.learn_extractor(d, "text", 20), html="text"),
    }


WHOLE = ("masked_lm", "language_id", "token_counts", "quality", "decontaminate", "secret_scan", "fill_in_middle", "restore_texts", "html_extract")


@pytest.mark.parametrize("name", [
    "masked_lm", "language_id", "url_filter", "licenses", "token_counts", "mixing", "simhash", "quality", "decontaminate", "secret_scan",
    "fill_in_middle", "restore_texts", "html_extract",
])
def test_every_row_gets_its_result(spark, name):
    docs = make(spark)
    run = operators(spark)[name]
    out = run(docs)
    rows = out.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in rows) == sorted((r[0] is None, r[0]) for r in ROWS)
    lowered = [c.lower() for c in out.columns]
    assert len(set(lowered)) == len(lowered)
    if name in WHOLE:  # other columns pass unchanged, those with the names of results give way
        assert set(c for c in docs.columns if c.lower() not in ("score", "rejected", "lang_pred", "kept", "n_words", "matches", "secrets", "form")) <= set(out.columns)
        assert out.select("a map", "source").dtypes == docs.select("a map", "source").dtypes
    assert run(docs.limit(0)).collect() == []
    same = [tuple(map(str, r)) for r in rows if r["doc_id"] == 4]
    if name not in WHOLE + ("url_filter", "mixing"):
        assert len(set(same)) == 1  # rows alike in id and text


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, tmp_path, name, stage):
    spark.createDataFrame([(4, 1, 0), (5, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "lazy dog and then it runs back home"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make(spark)
    out = stage(spark, docs, str(tmp_path))
    rows = out.collect()
    if name != "mixing_sources":
        assert out.columns == docs.columns
    else:
        words = {r[0]: len((r[1] or "").split()) for r in ROWS}
        assert out.columns == [c for c in docs.columns if c not in mixing.RESULT] + [*mixing.RESULT]
        assert ids_of(rows) and all(words[r["doc_id"]] == r["size"] and 0 < r["taken"] <= 2 * r["size"] for r in rows)
        assert all(r["text"] in {t for i, t, *_ in ROWS if i == r["doc_id"]} for r in rows)
    assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
    ids = ids_of(rows)
    assert ids == {
        "quality_rules": ["4", "4", "4", "5"],
        "simhash_near_dedup": ["1", "3", "4", "7", "None"],
        "benchmark_decontamination": ["1", "2", "3", "6", "7"],
        "secret_scans": sorted(str(r[0]) for r in ROWS),
        "mixing_sources": ids,
    }[name]


def test_run_on_no_documents(spark, tmp_path):
    make(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
