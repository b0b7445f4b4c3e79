import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kindred.plans.catalogue import build_catalogue
from kindred.sinks.zones import publish
from kindred.streaming.ingest import ingest_new_files, read_ingested
from kindred_checks import wiring


def test_whole_build(spark, tmp_path):
    content = spark.createDataFrame([
        ("1", "Dragons guard the ancient castle. Dragons breathe fire.", 2000, "movie", "Castle"),
        ("1", "An ancient castle under siege by dragons.", 2001, "anime", "Siege"),
        ("2", None, None, "anime", "Nothing said"),
        ("1", None, 2000, "movie", "Castle, listed again"), (None, "Dragons everywhere.", 1, "movie", "No id"),
        (None, "Castle castle.", 1, None, "No type"),
    ], "content_id string, description string, release_year int, type string, title string")
    ratings = spark.createDataFrame(
        [("ann", "movie", "1", 9.0), ("ann", "anime", "1", 8.0), ("bob", "anime", "2", 3.0), ("cy", "movie", "77", 9.0)],
        "user_id string, type string, content_id string, rating double").withColumn(
        "rating_date", F.lit(None).cast("timestamp"))
    t = build_catalogue(spark, ratings, content, str(tmp_path), dim=8)
    assert rows(t["user_content"].select("user_id", "content_id"), "user_id", "content_id") == [
        ("ann", "1"), ("ann", "1"), ("bob", "2")]
    nodes = {(r["type"], r["content_id"]): r for r in t["nodes_content"].collect()}
    assert len(nodes) == 3
    for key in (("movie", "1"), ("anime", "1")):
        assert len(nodes[key]["embedding"]) == 8
        assert nodes[key]["pagerank"] > 0.15 and nodes[key]["centrality"] > 0.15
    # Only a dislike: a node without neighbours.
    assert nodes[("anime", "2")]["pagerank"] == pytest.approx(0.15) == nodes[("anime", "2")]["centrality"]
    assert nodes[("anime", "2")]["embedding"] == [0.0] * 8
    assert nodes[("anime", "2")]["title"] == "Nothing said"
    users = {(r["user_id"], r["type"]): r["embedding"] for r in t["nodes_users"].collect()}
    assert any(users[("ann", "movie")]) and users[("bob", "anime")] == [0.0] * 8
    assert t["nodes_keyword"].filter("keywords = 'dragons'").count() == 1
    assert t["edges"].select("rel").distinct().count() == 3


def test_ingest_reads_each_file_once_and_merges(spark, tmp_path):
    schema = "id int, p string, q string"
    for sub in ("in", "out", "ck"):
        (tmp_path / sub).mkdir()

    def run():
        ingest_new_files(
            spark, str(tmp_path / "in"), str(tmp_path / "ck"), lambda b: b.filter("id > 0"),
            str(tmp_path / "out"), schema, source_format="json")
        return rows(read_ingested(spark, str(tmp_path / "out"), ["id"]), "id")

    (tmp_path / "in" / "a.json").write_text('{"id":1,"p":"a","q":"x"}\n{"id":0,"p":"no"}\n')
    assert run() == [(1, "a", "x")]
    (tmp_path / "in" / "b.json").write_text('{"id":1,"p":"b"}\n{"id":2,"q":"y"}\n')
    assert run() == [(1, "b", "x"), (2, None, "y")]
    assert run() == [(1, "b", "x"), (2, None, "y")]
    # Two rows for a key in one file: one of them counts, never a mixture.
    (tmp_path / "in" / "c.json").write_text('{"id":3,"p":"a1","q":"b9"}\n{"id":3,"p":"a5","q":"b2"}\n')
    assert run()[-1] == (3, "a5", "b2")


def test_published_types_stay(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "02"), ("c", None)], "x string, type string")
    back = publish(df, str(tmp_path), "t")
    assert back.dtypes == df.dtypes and rows(back, "x") == [("a", "1"), ("b", "02"), ("c", None)]


def test_entry_and_contract(spark):
    assert entry.entry(spark).count() == 30
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    assert set(wiring.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ["undirected_graph", "rating_edges"])
def test_columns_are_named_like_the_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("part", "lineitem", "orders", "events", "embeddings", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns) and got.count() == len(want)
