"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.llm import (
    decontaminate, fill_in_middle, html_extract, language_id, licenses, masked_lm, mixing, quality, secret_scan, simhash,
    spelling, token_counts, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
# The URL rules.
URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)
# What the method blocks where no rule fits: pages made for machines or for shopping carts.
BLOCKED_URLS = ("*/wp-admin*", "*/*login*", "*/cart*", "ads.*/*", "*/*.xml", "m.*/*/9??")


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark, sf, name) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_masked_lm(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return masked_lm.score_documents(docs, masked_lm.train_masked_lm(docs), keep=["doc_id"])


@query
def op2_language_id(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held_out)
    model = language_id.learn_languages(docs.filter("NOT held_out"))
    return language_id.identify_language(docs, model, keep=["doc_id", "held_out"])


@query
def op3_url_filter(spark, sf) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES, BLOCKED_URLS, keep=["page_id"])


@query
def op4_license_scan(spark, sf) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["exact"])
    joined = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    starts = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )


@query
def op5_token_counts(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, token_counts.read_pieces(TOKENIZER), keep=["doc_id"])


@query
def op6_mixing(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_simhash(spark, sf) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op8_quality(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf, "labels"))
    return quality.judge_quality(docs, model, keep=["doc_id"])


@query
def op9_decontamination(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf, "benchmark"), keep=["doc_id"])
    # The outer form: the inner one tests the size of the list first, which makes it twice.
    return found.select("doc_id", F.inline_outer("matches")).filter("item_id IS NOT NULL")


@query
def op10_secrets(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, keep=["doc_id"])
    kinds = [rule.kind for rule in secret_scan.BASE_RULES]
    number = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id", *[number(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"),
    )


@query
def op11_spelling(spark, sf) -> DataFrame:
    words = spelling.word_counts(table(spark, sf, "documents").select("doc_id", "text"), misspell_every=31)
    return spelling.group_variants(words)


@query
def op12_fill_in_middle(spark, sf) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf, "documents").select("doc_id", "text"), keep=["doc_id"])
    rebuilt = fill_in_middle.restore_texts(made)
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return rebuilt.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


@query
def op13_html_extraction(spark, sf) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return html_extract.extract_main_text(pages, html_extract.learn_extractor(pages), keep=["page_id", "url"])
