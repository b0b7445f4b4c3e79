"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed byte trigrams, weighted by TF-IDF and of length one. The vectors
of each language are clustered, and a text gets the language of the centroid with the largest cosine.
A text farther from its centroid than almost all texts it was learnt from is marked as rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from kindred.llm.buffers import add_columns, blocks

UNKNOWN = "und"
BITS = 12
SIZE = 1 << BITS
ROWS = 256
_SPACE = 0x20
# Everything in ASCII that is not a small letter reads as a space; texts are lower-cased before.
_READ = np.where((np.arange(256) >= 0x80) | ((np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A)), np.arange(256), _SPACE).astype(np.uint32)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray  # one per row
    owner: np.ndarray  # the language of a centroid
    nearest: np.ndarray  # the least cosine that is not rejected, per language


def trigram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each bucket's trigrams are in each text, a space put around every text."""
    texts = len(offsets) - 1
    padded = np.insert(data, np.repeat(offsets, 2)[1:-1], _SPACE)
    at = offsets + 2 * np.arange(texts + 1)
    codes = _READ[padded]
    if len(codes) < 3:
        return np.zeros((texts, SIZE), np.int64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    gram = ((a << 16) | (b << 8) | c) * np.uint32(2654435761) >> np.uint32(32 - BITS)
    wanted = np.flatnonzero(~((b == _SPACE) & ((a == _SPACE) | (c == _SPACE))))
    rows = np.repeat(np.arange(texts), np.diff(at))[wanted]
    return np.bincount(rows * SIZE + gram[wanted], minlength=texts * SIZE).reshape(texts, SIZE)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts.astype(np.float32)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _cluster(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Up to ``k`` directions: each next start is the vector farthest from those chosen."""
    chosen = [int(np.argmax(x @ x.mean(0)))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(1))))
    centres = x[chosen]
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        filled = np.bincount(own, minlength=len(centres)) > 0
        centres = sums[filled] / np.maximum(np.linalg.norm(sums[filled], axis=1, keepdims=True), 1e-12)
    return centres


def learn_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 300,
    most_sample: int = 4000,
    clusters: int = 4,
    rounds: int = 10,
    reject_share: float = 0.005,
) -> Model:
    """Learns from the rows of ``docs`` whose text and language are not null.

    The document frequencies are those of all these rows. The centroids come from a sample: about
    ``per_language`` rows of each language, fewer where ``most_sample`` would be passed, taken by a
    hash of id and text. ``reject_share`` of a language's sample lie below its least cosine.
    Repeated rows count as often as they occur; without rows there is no language to learn.
    """
    spark = docs.sparkSession
    known = docs.select(
        F.lower(docs[f"`{text}`"]).alias("text"), docs[f"`{lang}`"].alias("lang"),
        F.pmod(F.xxhash64(docs[f"`{id_col}`"], docs[f"`{text}`"]), F.lit(1 << 30)).alias("draw"),
    ).filter("text IS NOT NULL AND lang IS NOT NULL")

    def frequencies(batches):
        total = np.zeros(SIZE, np.int64)
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0), most_rows=ROWS):
                total += (trigram_counts(data, offsets) > 0).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SIZE)), pa.array(total)], names=["bucket", "texts"])

    rows = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(rows))
    if not languages:
        return Model((), np.zeros(SIZE, np.float32), np.zeros((0, SIZE), np.float32), np.zeros(0, int), np.zeros(0))
    found = known.select("text").mapInArrow(frequencies, "bucket long, texts long").groupBy("bucket").agg(F.sum("texts").alias("texts")).collect()
    texts = np.zeros(SIZE)
    for row in found:
        texts[row["bucket"]] = row["texts"]
    idf = np.log((1 + sum(rows.values())) / (1 + texts)).astype(np.float32) + np.float32(0.01)

    wanted = min(per_language, max(1, most_sample // len(languages)))
    chances = spark.createDataFrame(
        [(name, int(min(1.0, wanted / rows[name]) * (1 << 30)) + 1) for name in languages], "lang string, below long"
    )
    few = known.join(F.broadcast(chances), "lang").filter("draw < below").select("lang", "draw", "text")

    def sampled(batches):
        for batch in batches:
            for low, high, data, offsets in blocks(batch.column(2), most_rows=ROWS):
                counts = trigram_counts(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low),
                     pa.array([r.tobytes() for r in counts.astype(np.uint32)], pa.binary())],
                    names=["lang", "draw", "counts"],
                )

    sample = sorted(few.mapInArrow(sampled, "lang string, draw long, counts binary").collect())
    centroids, owner, nearest = [], [], np.zeros(len(languages))
    for k, name in enumerate(languages):
        mine = [np.frombuffer(r["counts"], np.uint32) for r in sample if r["lang"] == name]
        if not mine:
            continue
        x = _vectors(np.array(mine), idf)
        centres = _cluster(x, clusters, rounds)
        centroids.append(centres)
        owner += [k] * len(centres)
        nearest[k] = np.quantile((x @ centres.T).max(1), reject_share)
    return Model(languages, idf, np.concatenate(centroids), np.array(owner), nearest)


def identify_language(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the cosine, 0 to 1) and ``rejected``.

    A text without a letter, a null or empty one included, is ``und`` with score 0 and rejected; so
    is every text where no language was learnt. Of centroids at the same distance the first language
    by name wins. Rows are judged one by one, an empty table stays empty, and columns with the new
    names are replaced. A very long text is judged whole, by itself: its memory grows with its length.
    """
    def compute(column):
        lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
        if model.languages:
            for low, high, data, offsets in blocks(column, most_rows=ROWS):
                cosines = _vectors(trigram_counts(data, offsets), model.idf) @ model.centroids.T
                at = cosines.argmax(1)
                best[low:high] = model.owner[at]
                score[low:high] = np.clip(cosines[np.arange(len(at)), at], 0, 1)
        else:
            lettered = np.zeros(len(column), bool)
        names = np.array([*model.languages, UNKNOWN], object)
        best = np.where(lettered, best, len(model.languages))
        score = np.where(lettered, score, 0.0)
        least = np.append(model.nearest, 2.0)
        return [pa.array(names[best], pa.string()), pa.array(score), pa.array(score < least[best])]

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
    return add_columns(docs, F.lower(docs[f"`{text}`"].cast("string")), fields, compute, keep)
