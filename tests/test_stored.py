"""What is kept between runs: ingested batches and bases, bucketed zones, stored keys; and what is sorted out."""

import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kindred.operators import incremental, sample
from kindred.operators.titles import find_contents
from kindred.sinks.buckets import read_bucketed, upsert_bucketed
from kindred.sinks.documents import write_documents
from kindred.sources.rejects import read_anime_lists_checked, read_collections_checked, read_json_checked, read_xml_checked
from kindred.streaming import ingest
from test_sources import COLLECTION, put


@pytest.fixture
def target(spark, tmp_path):
    """A target with batches 0 to 2, and the files that more can be made from."""
    for sub in ("in", "out", "ck"):
        (tmp_path / sub).mkdir()

    def add(name, *docs):
        (tmp_path / "in" / f"{name}.json").write_text("".join(json.dumps(d) + "\n" for d in docs))
        ingest.ingest_new_files(
            spark, str(tmp_path / "in"), str(tmp_path / "ck"), lambda b: b, str(tmp_path / "out"),
            "id int, p string, q string", source_format="json",
        )

    add("a", {"id": 1, "p": "a", "q": "x"}, {"id": 2, "p": "b"})
    add("b", {"id": 1, "p": "b"}, {"id": 3, "q": "y"})
    add("c", {"id": 2, "q": "z"})
    return str(tmp_path / "out"), add


WANT = [(1, "b", "x"), (2, "b", "z"), (3, None, "y")]


def table(spark, path):
    return rows(ingest.read_ingested(spark, path, ["id"]), "id")


def files(df):
    return {Path(f).parent.name for f in df.inputFiles()}


def test_compaction_changes_no_row_and_reads_less(spark, target):
    path, add = target
    assert table(spark, path) == WANT
    assert ingest.compact_ingested(spark, path, ["id"]) == 2
    assert ingest.compact_ingested(spark, path, ["id"]) is None
    assert table(spark, path) == WANT
    add("d", {"id": 3, "p": "new"}, {"id": 4, "p": "n"})
    assert table(spark, path) == [*WANT[:2], (3, "new", "y"), (4, "n", None)]
    whole, newer = ingest._versions(spark, path)
    assert newer == [3] and files(whole) == {"batch=3", Path(ingest._bases(spark, path)[-1][1]).name}
    assert ingest.compact_ingested(spark, path, ["id"]) == 3
    assert files(ingest.read_ingested(spark, path, ["id"])) == {Path(ingest._bases(spark, path)[-1][1]).name}
    # A null in a later batch still leaves what a base says.
    add("e", {"id": 1, "q": "w"})
    assert table(spark, path)[0] == (1, "b", "w")


def test_what_is_folded_can_be_dropped(spark, target):
    path, add = target
    assert ingest.drop_folded(spark, path) == []
    ingest.compact_ingested(spark, path, ["id"])
    add("d", {"id": 4, "p": "n"})
    ingest.compact_ingested(spark, path, ["id"])
    add("e", {"id": 5, "p": "n"})
    want = table(spark, path)
    assert len(want) == 5
    ingest.drop_folded(spark, path, bases=2)
    assert sorted(p.name for p in Path(path).glob("batch=*")) == ["batch=3", "batch=4"] and table(spark, path) == want
    ingest.drop_folded(spark, path, bases=1)
    assert [p.name for p in Path(path).glob("batch=*")] == ["batch=4"] and table(spark, path) == want
    assert len(list(Path(path, "_bases").glob("*.ready"))) == 1
    assert ingest.drop_folded(spark, path, bases=1) == []


def test_failures_leave_no_copy(spark, target, monkeypatch):
    path, _ = target

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "mark", fail)
        with pytest.raises(OSError):
            ingest.compact_ingested(spark, path, ["id"])
    assert table(spark, path) == WANT and ingest._bases(spark, path) == []
    # A batch that is not finished is neither read nor folded.
    Path(path, "batch=3").mkdir()
    assert ingest.compact_ingested(spark, path, ["id"]) == 2 and table(spark, path) == WANT
    # A batch repeated after it was folded changes nothing.
    spark.createDataFrame([(1, "old", "old")], "id int, p string, q string").write.mode("overwrite").parquet(f"{path}/batch=2")
    assert table(spark, path) == WANT
    assert len(list(Path(path, "_bases").glob("*.ready"))) == 1
    ingest.drop_folded(spark, path, bases=1)
    assert len([p for p in Path(path, "_bases").iterdir() if p.is_dir()]) == 1 and table(spark, path) == WANT


def test_nothing_ingested(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest.read_ingested(spark, str(tmp_path / "no"), ["id"])
    assert ingest.compact_ingested(spark, str(tmp_path / "no"), ["id"]) is None


# --- buckets ---

def names(path):
    return {p.parent.name: p.name for p in Path(path).glob("bucket=*/*.parquet")}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "zone")
    old = spark.range(200).selectExpr("id", "'a' AS p", "id * 2 AS q")
    assert upsert_bucketed(old, path, ["id"], buckets=8) == list(range(8))
    before = names(path)
    new = spark.createDataFrame([(7, "b", None), (7, "a", None), (900, "n", 1)], "id long, p string, q long")
    touched = upsert_bucketed(new, path, ["id"])
    after = names(path)
    assert 1 <= len(touched) <= 2 and len(after) == 8
    assert {b for b in after if after[b] != before[b]} == {f"bucket={t}" for t in touched}
    got = rows(read_bucketed(spark, path), "id")
    assert len(got) == 201 and got[7] == (7, "b", 14) and got[200] == (900, "n", 1) and got[8] == (8, "a", 16)
    again = names(path)
    assert upsert_bucketed(new.limit(0), path, ["id"]) == [] and names(path) == again
    upsert_bucketed(new, path, ["id"])  # the same merge once more changes nothing
    assert rows(read_bucketed(spark, path), "id") == got


def test_new_columns_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "zone")
    upsert_bucketed(spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, p string"), path, ["id"], buckets=4)
    upsert_bucketed(spark.createDataFrame([(2, 5), (None, 6)], "id int, r int"), path, ["id"])
    got = {r["id"]: (r["p"], r["r"]) for r in read_bucketed(spark, path).collect()}
    assert got == {1: ("a", None), 2: ("b", 5), None: ("c", 6)}


# --- stored keys ---

def test_stored_keys_are_not_moved(spark):
    first, second = spark.range(0, 500), spark.range(400, 900)
    incremental.store_keys(first, "id", "fetched_keys", buckets=8)
    incremental.store_keys(second, "id", "fetched_keys")
    wanted = spark.range(880, 1000).selectExpr("CASE WHEN id < 990 THEN id END AS id")
    todo = incremental.frontier_of_stored(wanted, "fetched_keys", "id")
    assert rows(todo, "id") == [(i,) for i in range(900, 990)]
    plan = todo._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("fetched_keys") - 400 :] if "fetched_keys" in plan else ""
    assert "SelectedBucketsCount: 8 out of 8" in plan and stored
    join = plan[plan.index("SortMergeJoin"):]
    right = join[join.rindex("Scan parquet") - 200 :] if "Scan parquet" in join else join
    assert "Exchange" not in right and plan.count("Exchange hashpartitioning") == 1


# --- bad documents ---

def test_bad_collections_are_kept_with_their_reason(spark, tmp_path):
    put(tmp_path / "c" / "ann.xml", COLLECTION)
    put(tmp_path / "c" / "bö b%+.xml", COLLECTION.replace("x11", "99"))
    put(tmp_path / "c" / "broken.xml", COLLECTION.replace("</items>", "<item></items>"))
    put(tmp_path / "c" / "cut.xml", COLLECTION[:-40])
    put(tmp_path / "c" / "empty.xml", " \n")
    put(tmp_path / "c" / "other.xml", "<things><item/></things>")
    found = read_collections_checked(spark, str(tmp_path / "c"), str(tmp_path / "store"))
    assert rows(found.good.select("user_id", "content_id"), "user_id", "content_id") == [
        ("ann", "10"), ("ann", "12"), ("ann", "x11"), ("bö b%+", "10"), ("bö b%+", "12"), ("bö b%+", "99")]
    got = {Path(r["file"]).name: (r["reason"], r["document"]) for r in found.bad.collect()}
    assert {k: v for k, (v, _) in got.items()} == {
        "broken.xml": "not well formed", "cut.xml": "ends too early", "empty.xml": "empty",
        "other.xml": "does not begin as expected"}
    assert got["cut.xml"][1] == COLLECTION[:-40] and (found.n_good, found.n_bad) == (2, 4)


def test_bad_lists_are_kept_with_their_reason(spark, tmp_path):
    put(tmp_path / "u" / "a b+%.json", '[{"anime_id": 5, "score": 9},\n {"anime_id": 6}]')
    put(tmp_path / "u" / "bad.json", '[{"anime_id": 5, "sco')
    put(tmp_path / "u" / "odd.json", "anime")
    put(tmp_path / "u" / "mixed.json", '[{"anime_id" 5}]')
    put(tmp_path / "u" / "none.json", "[]")
    found = read_anime_lists_checked(spark, str(tmp_path / "u"), str(tmp_path / "store"))
    assert rows(found.good.select("user_id", "anime_id"), "anime_id") == [("a b+%", 5), ("a b+%", 6)]
    assert {Path(r["file"]).name: r["reason"] for r in found.bad.collect()} == {
        "bad.json": "ends too early", "odd.json": "does not begin as expected", "mixed.json": "not well formed"}
    assert (found.n_good, found.n_bad) == (2, 3)


def test_nothing_bad(spark, tmp_path):
    put(tmp_path / "j" / "a.json", '{"a": 1}')
    found = read_json_checked(spark, str(tmp_path / "j"), "a int", str(tmp_path / "s1"))
    assert rows(found.good.select("a")) == [(1,)] and found.bad.count() == 0 and found.n_bad == 0
    put(tmp_path / "x" / "a.xml", '<!-- a --><r a="1"/>')
    found = read_xml_checked(spark, str(tmp_path / "x"), "_a int", str(tmp_path / "s2"), "r")
    assert rows(found.good.select("_a")) == [(1,)] and found.bad.count() == 0


# --- samples ---

def test_samples(spark):
    df = spark.range(2000).selectExpr("id", "CASE WHEN id < 1500 THEN 'hot' WHEN id < 1503 THEN 'few' END AS kind").repartition(7)
    one = rows(sample.sample_n(df, 100, ["id"]).select("id"), "id")
    assert len(set(one)) == 100 and one == rows(sample.sample_n(df.repartition(3), 100, ["id"]).select("id"), "id")
    assert one != rows(sample.sample_n(df, 100, ["id"], seed=1).select("id"), "id")
    assert 40 < sum(r[0] < 1000 for r in one) < 60 or 30 < sum(r[0] < 1000 for r in one) < 70
    per = {r["kind"]: r["count"] for r in sample.sample_n(df, 10, ["id"], by=["kind"]).groupBy("kind").count().collect()}
    assert per == {"hot": 10, "few": 3, None: 10}
    assert sample.sample_n(df, 10_000, ["id"]).count() == 2000 and sample.sample_n(df.limit(0), 5, ["id"]).count() == 0
    some = set(rows(sample.sample_fraction(df, 0.3, ["id"]).select("id")))
    assert 500 < len(some) < 700 and set(rows(sample.sample_fraction(df, 0.1, ["id"]).select("id"))) < some
    plan = sample.sample_n(df, 10, ["id"], by=["kind"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    same = spark.createDataFrame([(1,)] * 5 + [(None,)] * 5, "id int")
    assert sample.sample_n(same, 7, ["id"]).count() == 7


# --- titles ---

def test_titles(spark):
    content = spark.createDataFrame([
        ("1", "movie", "The Ring"), ("2", "movie", "The Ring"), ("3", "anime", "Ringing bells"), ("4", "anime", "The Ring two"),
        ("5", "movie", "Ab"), (None, "movie", "Ring"), ("6", "movie", None), ("7", "game", "ÉTÉ 100%_x"), ("8", None, "a ring"),
    ], "content_id string, type string, title string")
    texts = spark.createDataFrame([
        (1, "ring", None), (2, "RING", "anime"), (3, "ring", "game"), (4, "nothing", None), (5, None, None), (6, "b", None),
        (7, "", None), (8, "", "anime"), (9, "été", None), (10, "0%_", None), (11, "g t", None), (12, "ring", None), (13, "zz", None),
    ], "n int, text string, kind string").withColumn("title", F.lit("clash"))
    got = rows(find_contents(content, texts, kind="kind").select("n", "content_id", "type", "title"), "n")
    assert got == [
        (1, "8", None, "a ring"), (2, "4", "anime", "The Ring two"), (6, "5", "movie", "Ab"), (7, "5", "movie", "Ab"),
        (8, "4", "anime", "The Ring two"), (9, "7", "game", "ÉTÉ 100%_x"), (10, "7", "game", "ÉTÉ 100%_x"),
        (11, "4", "anime", "The Ring two"), (12, "8", None, "a ring")]
    assert find_contents(content, texts).filter("n = 3").count() == 1
    assert find_contents(content.limit(0), texts).count() == 0 == find_contents(content, texts.limit(0)).count()


def test_a_file_per_key(spark, tmp_path):
    """The folders and lines of Spark's writer, also for keys that paths encode, and no checksum file beside each."""
    keys = ["a", "nr +%1", "Brand#12", "x=y/z[{]}'\"*:?\\^", "ä€", "tab\t", "", None]
    docs = spark.createDataFrame([(k, f"text {i}\r\nmore ü") for i, k in enumerate(keys)] + [("b", None)], "key string, doc string")
    mine, theirs = f"file://{tmp_path}/mine", f"file://{tmp_path}/theirs"
    write_documents(docs, mine)
    docs.repartition("key").write.partitionBy("key").text(theirs)
    folders = [sorted(p.name for p in (tmp_path / side).iterdir() if "=" in p.name) for side in ("mine", "theirs")]
    assert folders[0] == folders[1] and len(folders[0]) == len(keys)
    got, wanted = (rows(spark.read.text(p), "key", "value") for p in (mine, theirs))
    assert got == wanted
    assert [p.name for p in (tmp_path / "mine" / "key=a").iterdir()] == ["part-0.txt"]


def test_no_documents(spark, tmp_path):
    write_documents(spark.createDataFrame([], "key bigint, doc string"), f"{tmp_path}/none")
    assert spark.read.schema("value string").text(f"{tmp_path}/none").count() == 0
