import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from kindred import functions as fn
from kindred import schema as S
from kindred.operators import charts, edges, incremental, merge, nodes, playtime, profile
from kindred.operators.topk import top_per_group
from kindred.sinks.zones import publish, write_zone

RATED = "user_id string, type string, content_id string, rating double"


def test_text_functions(spark):
    df = spark.createDataFrame([("  Ann-Lee 7 ", "a%c", ["space WAR", "x", ""])], "u string, t string, k array<string>")
    got = df.select(
        fn.normalise_user("u"), fn.plain_user("u"), fn.contains_text("t", "%C"), fn.contains_text("t", "a.c"),
        fn.keyword_line("k"), fn.null_if("t", "N/A"), fn.null_if("t", "a%c"),
        fn.unescape_html(F.lit("&lt;&eacute;&#39;&amp;amp;")),
    )
    assert rows(got) == [("ann-lee 7", "annlee7", True, False, "Space war, X, ", "a%c", None, "<é'&amp;")]
    tab = spark.createDataFrame([("\tA ",)], "u string").select(fn.normalise_user("u"))
    assert rows(tab) == [("\ta",)]


def test_numbers_and_dates(spark):
    df = spark.range(1).select(
        *[fn.two_decimals(F.lit(x)) for x in (0.125, 1234.5, -0.375, 0.165)],
        fn.page_count(F.lit(201)), fn.last_year(F.lit("Oct 21, 2008")), fn.last_year(F.lit("Coming soon")),
        fn.last_year(F.lit("")), fn.first_year(F.lit("abcd")), fn.iso_date(F.lit("2020-02-30T00:00:00.000Z")),
        fn.iso_date(F.lit("2020-02-29T23:59:59.999Z")),
    )
    expected = tuple(f"{x:.2f}" for x in (0.125, 1234.5, -0.375, 0.165))
    assert rows(df) == [expected + (3, 2008, None, None, None, None, dt.date(2020, 2, 29))]


def test_vectors(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(fn.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1 / math.sqrt(2)) and got[1:] == [None, None]


def test_merge(spark):
    a = spark.createDataFrame([(" Ann ", "Movie", 1, "8", "2020-01-01 00:00:00")],
                              "user_id string, type string, content_id bigint, rating string, rating_date string")
    b = spark.createDataFrame([("bob", "x1", None)], "user_id string, content_id string, rating double")
    got = merge.merge_ratings(a, b)
    assert got.schema == S.RATINGS
    assert rows(got, "user_id") == [
        ("ann", "movie", "1", 8.0, dt.datetime(2020, 1, 1)), ("bob", None, "x1", None, None)]
    c = spark.createDataFrame([(str(i), "d", "movie", f"t{i}") for i in range(5)],
                              "content_id string, description string, type string, title string")
    both = merge.merge_content(c, c.withColumn("release_year", F.lit("19x")))
    assert both.count() == 10 and both.schema == S.CONTENT
    bad = c.limit(2).withColumn("content_id", F.lit(None).cast("string"))
    assert [r["content_id"] for r in merge.unique_content(both.unionByName(bad, True)).orderBy("content_id").collect()] == list("01234")


def test_profile(spark):
    df = spark.createDataFrame(
        [("a-b", "x"), ("AB", "y"), ("ab", "y"), ("c", "x"), ("c", "x")], "user_id string, type string")
    assert rows(profile.count_by(df, "type")) == [("x", 3), ("y", 2)]
    assert rows(profile.domains_per_user(df)) == [("ab", 2), ("c", 1)]
    assert rows(profile.user_by_type(df, "c")) == [("x", 2)]


def test_playtime_golden_example(spark):
    df = spark.createDataFrame(
        [("u", "1", 30), ("u", "2", 60), ("u", "3", 90), ("u", "4", 0), ("v", "1", 7)],
        "user_id string, content_id string, playtime bigint")
    got = playtime.normalise_playtime(df)
    assert rows(got, "user_id", "content_id") == [("u", "1", 4), ("u", "2", 7), ("u", "3", 10), ("v", "1", 10)]


def test_playtime_with_a_hot_user(spark):
    df = spark.range(1, 1001).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
        F.col("id").alias("playtime"), F.lit(None).cast("string").alias("note"))
    df = df.unionByName(df.limit(10)).unionByName(df.limit(5).withColumn("user_id", F.lit(None).cast("string")))
    got = rows(playtime.normalise_playtime(df), "user_id", "rating")
    best = F.max("playtime").over(Window.partitionBy("user_id"))
    plain = df.filter("user_id IS NOT NULL").select("user_id", "note", F.ceil(F.col("playtime") / best * 10).alias("rating"))
    assert got == rows(plain, "user_id", "rating")


def test_playtime_reads_and_moves_its_input_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("content_id"), F.col("l_quantity").alias("playtime"))
    rated = playtime.normalise_playtime(df)
    rated.collect()
    plan = rated._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert final.count("Scan parquet") == 1 and final.count("ReusedExchange") == 1


def sample_ratings(spark):
    return spark.createDataFrame([
        ("a", "m", "1", 8.0), ("a", "m", "1", 9.0), ("b", "m", "1", 7.99), ("c", "m", "1", 1.0),
        ("d", "m", "1", 0.5), ("e", "m", "1", 0.0), ("f", "m", "1", None), ("g", "m", "1", float("nan")),
        (None, "m", "1", 10.0), ("a", "m", "9", 10.0), ("a", "g", "1", 10.0)], RATED)


def test_user_content_and_rating_edges(spark):
    content = spark.createDataFrame([("m", "1"), ("m", "2")], "type string, content_id string")
    inner = edges.user_content(sample_ratings(spark), content)
    right = edges.user_content(sample_ratings(spark), content, how="right")
    assert inner.count() == 9
    plain = sample_ratings(spark).join(content, ["type", "content_id"])
    assert inner.count() == plain.count()
    assert right.filter("user_id is null and type is null and content_id is null").count() == 1
    assert right.count() == 10
    got = edges.edges_by_rating(right)
    assert got.columns == edges.EDGE_COLUMNS
    assert rows(got.select("rel", "dst_id"), "dst_id") == [("like", "a"), ("dislike", "b"), ("dislike", "c")]


def test_projection_is_symmetric(spark):
    kw = spark.createDataFrame([("1", "m", "war"), ("1", "m", "war"), ("2", "m", None)],
                               "content_id string, type string, keyword string")
    e = edges.edges_has_keyword(kw).unionByName(edges.edges_by_rating(sample_ratings(spark)))
    g = edges.project_undirected(e)
    assert g.exceptAll(g.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).count() == 0
    assert ("content|m|1", "keyword||war") in rows(g)
    assert g.filter(F.col("dst").contains("b")).count() == 0  # dislikes are not part of the graph
    split = nodes.split_node_id(spark.createDataFrame([("users|m|a|b", 1), ("keyword||x", 2)], "node string, v int"))
    assert rows(split, "v") == [("users", "m", "a|b", 1), ("keyword", None, "x", 2)]


def test_build_nodes(spark):
    content = spark.createDataFrame(
        [("1", "m", "T", "d"), ("1", "m", "T", "d"), ("2", "m", "U", None)],
        "content_id string, type string, title string, description string")
    kw = spark.createDataFrame([("war",), ("war",), (None,)], "keyword string")
    r = spark.createDataFrame([("A-b", "m"), ("ab", "g"), (None, "m")], "user_id string, type string")
    t = nodes.build_nodes(content, r, kw)
    assert rows(t["content"], "content_id") == [("1", "m", "T", "d"), ("2", "m", "U", None)]
    assert t["users"].count() == 2 and rows(t["keyword"]) == [("war",)]
    assert rows(nodes.build_nodes(content, r, kw, link_users=True)["users"]) == [("ab", None)]


def test_upsert_and_attach(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "id int, p string, q string")
    new = spark.createDataFrame([(2, None, "y", 5), (3, "c", None, 6)], "id int, p string, q string, r int")
    got = nodes.upsert_nodes(old, new, ["id"])
    assert rows(got, "id") == [(1, "a", "x", None), (2, "b", "y", 5), (3, "c", None, 6)]
    # Rows of a key are never mixed: the last by the order given counts, or else by the columns.
    twice = spark.createDataFrame([(1, "a1", "b9", 2), (1, "a5", "b2", 1), (4, None, "z", 1)], "id int, p string, q string, r int")
    assert rows(nodes.upsert_nodes(old, twice, ["id"], "r"), "id")[0] == (1, "a1", "b9", 2)
    assert rows(nodes.upsert_nodes(old, twice, ["id"]), "id")[0] == (1, "a5", "b2", 1)
    values = spark.createDataFrame([("n", "content", 1.0), ("m", "users", 2.0)], "node string, label string, v double")
    base = spark.createDataFrame([("n",), ("m",)], "node string")
    got = nodes.attach_node_property(base, values, ["node"], labels=("content",))
    assert rows(got, "node") == [("m", None), ("n", 1.0)]


def test_incremental(spark):
    want = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    have = spark.createDataFrame([(2,), (3,)], "id int")
    assert rows(incremental.frontier(want, have, "id")) == [(1,)]
    assert rows(incremental.high_water_mark(have, "id")) == [(3,)]


def test_charts(spark):
    e = spark.createDataFrame(
        [("1", "m", "like", "a", "m"), ("1", "m", "like", "b", "m"), ("2", "m", "like", "a", "m"),
         ("3", "m", "like", "a", "m"), ("3", "m", "dislike", "z", "m"), ("1", "g", "like", "a", "g")],
        "src_id string, src_type string, rel string, dst_id string, dst_type string")
    content = spark.createDataFrame(
        [(i, t, f"T{i}") for i, t in (("1", "m"), ("2", "m"), ("3", "m"), ("1", "g"))],
        "content_id string, type string, title string")
    got = charts.top_by_popularity(e, content, k=2).select("type", "content_id", "title", "total_users", "rank")
    assert rows(got, "type", "rank") == [
        ("g", "1", "T1", 1, 1), ("m", "1", "T1", 2, 1), ("m", "2", "T2", 1, 2)]
    assert rows(charts.liker_count(e, "1", "m")) == [(2,)] and rows(charts.liker_count(e, "7", "m")) == [(0,)]
    n = content.withColumn("pagerank", F.when(F.col("content_id") != "2", F.lit(0.5)))
    assert charts.top_by_pagerank(n, 1).count() == 2 and charts.top_by_pagerank(n, 5).count() == 3


def test_top_per_group_prunes_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 2)
    top = top_per_group(df, ["g"], [F.desc("id")], 3)
    assert rows(top.select("id"), "id") == [(i,) for i in range(94, 100)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "m"), ("2", "g")], "content_id string, type string")
    back = publish(df, str(tmp_path), "merged")
    assert rows(back, "content_id") == [("1", "m"), ("2", "g")]
    assert (tmp_path / "merged" / "type=m").is_dir()
    write_zone(df, str(tmp_path / "one"), mode="errorifexists", files=1)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    with pytest.raises(Exception):
        write_zone(df, str(tmp_path / "one"), mode="errorifexists")
