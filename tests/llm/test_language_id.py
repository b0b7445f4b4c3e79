import math
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from kindred.llm import queries
from kindred.llm.buffers import utf8
from kindred.llm.language_id import SIZE, _cluster, identify_language, learn_languages, trigram_counts

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    data = [c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in (" " + text.lower() + " ").encode()]
    out = Counter()
    for a, b, c in zip(data, data[1:], data[2:]):
        if b != 0x20 or (a != 0x20 and c != 0x20):
            out[(((a << 16 | b << 8 | c) * 2654435761) % (1 << 32)) >> 20] += 1
    return out


def test_predictions_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2 and r[1] is not None and r[2] is not None]
    model = learn_languages(spark.createDataFrame(learnt, docs.schema))
    counts = {r[0]: plain_counts(r[1] or "") for r in rows}
    met = Counter(bucket for r in learnt for bucket in counts[r[0]])
    idf = [math.log((1 + len(learnt)) / (1 + met[b])) + 0.01 for b in range(SIZE)]
    assert np.allclose(model.idf, idf, atol=1e-5)
    assert model.languages == tuple(sorted({r[2] for r in learnt}))
    assert all(1 <= n <= 4 for n in Counter(model.owner.tolist()).values())
    centroids = [c / math.sqrt(sum(c * c)) for c in model.centroids.astype(float)]
    got = {r["doc_id"]: r for r in queries.op2_language_id(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
            assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
            continue
        weights = {b: math.log(1 + n) * idf[b] for b, n in counts[i].items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        buckets, values = [*weights], np.array([*weights.values()]) / length
        cosines = [float(c[buckets] @ values) for c in centroids]
        best = max(cosines)
        assert abs(got[i]["score"] - best) < 1e-4
        near = {model.owner[k] for k, c in enumerate(cosines) if c > best - 1e-5}
        assert got[i]["lang_pred"] in {model.languages[k] for k in near}
        limit = model.nearest[model.languages.index(got[i]["lang_pred"])]
        assert got[i]["rejected"] == (best < limit) or abs(best - limit) < 1e-4


def test_clusters_are_the_directions_of_their_vectors():
    rng = np.random.default_rng(5)
    corners = np.eye(6)[:4]
    x = np.repeat(corners, 25, axis=0) + rng.uniform(0, 0.2, (100, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = [x[25 * k : 25 * k + 25].sum(0) for k in range(4)]
    got = _cluster(x[rng.permutation(100)], 4, 10)
    assert len(got) == 4
    for w in want:
        assert np.isclose(got @ (w / np.linalg.norm(w)), 1).sum() == 1
    assert len(_cluster(x[:1], 4, 10)) == 1


def test_trigrams_against_a_plain_version():
    texts = ["", "a", "ab  cd", "é1é", "x", "...", None, "abcabc"]
    counts = trigram_counts(*utf8(pa.array(texts)))
    for text, row in zip(texts, counts, strict=True):
        want = plain_counts(text or "")
        assert row.tolist() == [want[b] for b in range(SIZE)]


def test_held_out_accuracy(spark):
    got = queries.op2_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and 180 < len(held) < 320
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.99 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_cases_without_letters_languages_or_rows(spark):
    train = spark.createDataFrame(
        [(i, "the cat and the dog", "en") for i in range(9)] + [(i, "der hund und die katze", "de") for i in range(9, 18)]
        + [(20, None, "en"), (21, "le chat", None), (None, "the dog", "en")],
        "doc_id long, text string, lang string",
    )
    model = learn_languages(train)
    assert model.languages == ("de", "en")
    ask = spark.createDataFrame([(1, None), (2, ""), (3, "12 ??"), (4, "THE DOG"), (5, "die Katze"), (6, "日本語")], "id int, text string")
    got = {r["id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in identify_language(ask, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0, True)] * 3
    assert got[4][0] == "en" and got[5][0] == "de" and got[6][0] in model.languages and got[6][2]
    empty = learn_languages(train.limit(0))
    assert {r["lang_pred"] for r in identify_language(ask, empty).collect()} == {"und"}
    assert identify_language(ask.limit(0), model).collect() == []


def test_a_trigram_met_very_often_counts_whole(spark):
    from kindred.llm import language_id

    text = "xyz " * 65537 + "abc " * 300
    docs = spark.createDataFrame([(1, text, "xx")], "doc_id long, text string, lang string")
    row = language_id.identify_language(docs, language_id.learn_languages(docs)).first()
    assert row["score"] > 0.9999  # its own vector is the only centroid
