"""One query per operator on the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kindred import functions as fn
from kindred import schema as S
from kindred.operators import (
    centrality, charts, edges, embedding, incremental, keywords, merge, nodes, playtime, profile,
    recommend, sample, titles, vector_index,
)
from kindred.operators.graph import Adjacency
from kindred.operators.topk import top_per_group
from kindred.plans import anime, movie, videogame
from kindred.plans.catalogue import build_catalogue
from kindred.session import release, scratch_path
from kindred.sinks.buckets import read_bucketed, upsert_bucketed as upsert_into_buckets
from kindred.sinks.documents import write_documents
from kindred.sinks.zones import publish, write_zone
from kindred.sources import (
    catalogue_content, collection_ratings, consolidate_documents, keyed_entries, keyed_list_entries,
    read_anime_info, read_anime_lists, read_catalogue_xml, read_collections_xml, read_id_export,
    read_keyed_json, read_keyed_json_list, read_latest_snapshot, read_parquet_many,
    read_review_json, read_review_pages_xml, read_review_totals_xml, review_comments, reviewers,
)
from kindred.sources.rejects import read_anime_lists_checked, read_collections_checked
from kindred.streaming.ingest import compact_ingested, drop_folded, ingest_new_files, read_ingested

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The domains of `part`, the parameters of the single-item queries.
KINDS = ("economy", "standard", "small", "medium", "large", "promo")
TEXT, KIND, CONTENT_ID, USER = "ring", "economy", "1", "7"


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark, sf, name) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(name):
    return F.col(name).cast("string")


def rounded(name):
    return F.round(name, 6).alias(name)


def content(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        text("p_partkey").alias("content_id"),
        F.concat_ws(" ", "p_brand", "p_name").alias("description"),
        (F.col("p_size") + 1970).alias("release_year"),
        F.lower("p_type").alias("type"),
        F.col("p_name").alias("title"),
    )


def documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        text("doc_id").alias("content_id"),
        F.col("text").alias("description"),
        F.col("lang").alias("type"),
        F.col("source").alias("title"),
    )


def plays(spark, sf) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    return (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            text("o_custkey").alias("user_id"),
            F.lower("p_type").alias("type"),
            text("l_partkey").alias("content_id"),
            F.col("l_quantity").alias("playtime"),
            F.col("o_orderdate").alias("rating_date"),
        )
    )


def ratings(spark, sf) -> DataFrame:
    return S.conform(playtime.normalise_playtime(plays(spark, sf)), S.RATINGS)


def rated_content(spark, sf) -> DataFrame:
    """Ratings of known content. Dates are left out, and the ratings are written first: the plays are used twice, and what is
    later asked of one use only (fewer columns, keys that are not null) would have them joined and moved twice."""
    rated = playtime.normalise_playtime(plays(spark, sf).drop("rating_date"))
    rated = stored(spark, S.conform(rated, S.RATINGS).drop("rating_date"), "ratings")
    return edges.user_content(rated, content(spark, sf))


def stored(spark, df, name) -> DataFrame:
    """Written once and read back, as the build does between its stages."""
    path = scratch_path(spark, name)
    write_zone(df, path)
    release(spark)
    return spark.read.parquet(path)


def event_ratings(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.concat(F.lit(" User-"), text("user_id")).alias("user_id"),
        F.upper("event_type").alias("type"),
        F.from_json("props", "map<string,string>")["k"].alias("content_id"),
        F.col("value").alias("rating"),
        F.col("ts").alias("rating_date"),
    )


def merged(spark, sf) -> DataFrame:
    return merge.merge_ratings(ratings(spark, sf), event_ratings(spark, sf))


def title_keywords(spark, sf) -> DataFrame:
    return content(spark, sf).select(
        "content_id", "type", F.explode(F.split("title", " ")).alias("keyword")
    )


def rating_edge_table(spark, sf) -> DataFrame:
    return edges.edges_by_rating(edges.user_content(ratings(spark, sf), content(spark, sf)))


def keyword_edge_table(spark, sf) -> DataFrame:
    return edges.edges_has_keyword(title_keywords(spark, sf))


def graph(spark, sf, rated: DataFrame | None = None) -> Adjacency:
    """The undirected graph over all nodes. Ratings of known content are written once, for nodes and edges, and so are
    the edges: the jobs read them several times."""
    rated = stored(spark, rated_content(spark, sf), "rated") if rated is None else rated
    tables = nodes.build_nodes(content(spark, sf), rated, title_keywords(spark, sf))
    both = edges.edges_by_rating(rated).unionByName(keyword_edge_table(spark, sf))
    return Adjacency(nodes.node_list(tables), stored(spark, edges.project_undirected(both), "graph"))


def vectors(spark, sf) -> DataFrame:
    """Content with an embedding and a description."""
    v = table(spark, sf, "embeddings").select(
        text("vec_id").alias("content_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    return content(spark, sf).join(v, "content_id")


def best_title(spark, sf) -> DataFrame:
    return recommend.find_content(vectors(spark, sf), TEXT, KIND)


# --- ratings -----------------------------------------------------------------------------------

@query
def playtime_rating(spark, sf):
    return ratings(spark, sf)


@query
def merged_ratings(spark, sf):
    return merged(spark, sf)


@query
def merged_content(spark, sf):
    return merge.merge_content(content(spark, sf), documents(spark, sf))


@query
def merged_content_capped(spark, sf):
    """A listing: the first five contents of each type by id and title."""
    both = merge.merge_content(content(spark, sf), documents(spark, sf))
    return top_per_group(both, ["type"], ["content_id", "title"], 5)


@query
def unique_content(spark, sf):
    """Parts listed twice, some without an id, to one row per id and type."""
    parts = content(spark, sf)
    number = F.col("content_id").cast("int")
    again = parts.withColumns({"title": F.concat(F.lit("about "), "title"), "description": F.lit(None).cast("string")})
    none = parts.filter(number % 7 == 0).withColumn("content_id", F.lit(None).cast("string"))
    return merge.unique_content(parts.unionByName(again.filter(number % 3 == 0)).unionByName(none))


@query
def count_ratings_by_type(spark, sf):
    return profile.count_by(merged(spark, sf), "type")


@query
def count_content_by_type(spark, sf):
    return profile.count_by(merge.merge_content(content(spark, sf), documents(spark, sf)), "type")


@query
def count_by_user(spark, sf):
    return profile.count_by(merged(spark, sf), "user_id")


@query
def domains_per_user(spark, sf):
    return profile.domains_per_user(merged(spark, sf))


@query
def user_by_type(spark, sf):
    return profile.user_by_type(merged(spark, sf), USER)


@query
def titles_in_order(spark, sf):
    """The order is the result, so each title has its place."""
    first = profile.titles_in_order(content(spark, sf), KIND, 20)
    place = F.row_number().over(Window.partitionBy("type").orderBy("title", "content_id"))
    return first.select("content_id", "title", place.alias("place"))


@query
def first_ids(spark, sf):
    return merge.first_rows(table(spark, sf, "part").select("p_partkey"), ["p_partkey"], 150)


@query
def sample_rows(spark, sf):
    """About one row in 256, drawn by a hash of its key, so that every run draws the same."""
    key = F.concat_ws(":", "l_orderkey", "l_linenumber")
    return table(spark, sf, "lineitem").filter(F.left(F.md5(key), F.lit(2)) == "07").select("l_orderkey", "l_linenumber")


@query
def sample_exactly(spark, sf):
    """A thousand sales, the same in every run. Some are listed twice; either one may stand for both."""
    return sample.sample_n(sales(spark, sf), 1000, ["l_orderkey", "l_linenumber", "l_partkey"], seed="rows")


@query
def sample_per_flag(spark, sf):
    """Fifty of each return flag."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    return sample.sample_n(sales(spark, sf), 50, keys, seed="flags", by=["l_returnflag"])


@query
def sample_fraction(spark, sf):
    """About one sale in twenty."""
    return sample.sample_fraction(sales(spark, sf), 0.05, ["l_orderkey", "l_linenumber", "l_partkey"], seed=5)


def sales(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


# --- scalar functions ----------------------------------------------------------------------------

@query
def parse_props(spark, sf):
    props = F.from_json("props", "map<string,string>")
    return table(spark, sf, "events").filter(F.length("props") > 2).select(
        "event_id",
        props["k"].try_cast("bigint").alias("k"),
        fn.json_default(props, "personaname", "Unknown").alias("name"),
    )


@query
def dates_and_years(spark, sf):
    orders = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    printed = F.date_format("o_orderdate", "MMM dd, yyyy")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    return orders.select(
        "o_orderkey",
        fn.first_year(day).alias("first_year"),
        fn.last_year(printed).alias("last_year"),
        fn.iso_date(iso).alias("iso_date"),
        fn.epoch_date(seconds).cast("timestamp_ntz").alias("epoch_date"),
    )


@query
def unescape_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", fn.unescape_html("html").alias("html"))


@query
def embedding_sums(spark, sf):
    v = table(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>"))
    return embedding.embedding_check(v)


@query
def cosine_to_next(spark, sf):
    """The cosine expression, on each vector and the one with the next id."""
    v = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    following = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    return v.join(following, "vec_id").select(
        "vec_id",
        F.round(fn.cosine(F.col("a"), F.col("b")), 6).alias("similarity"),
        fn.two_decimals(F.col("vec_id") / 8).alias("shown"),
    )


# --- domains -------------------------------------------------------------------------------------

@query
def movie_ratings(spark, sf):
    """Reviews as JSON text, one review page per order line."""
    review = F.struct(
        F.concat(F.lit("Doe, J. "), "user_id").alias("author"),
        F.struct(F.coalesce(text("playtime"), F.lit("null")).alias("rating")).alias("author_details"),
        F.date_format("rating_date", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
    )
    pages = plays(spark, sf).select(
        F.col("content_id").alias("id"),
        F.when(F.col("playtime") > 1, F.to_json(F.array(review))).otherwise("[]").alias("results"),
    )
    return movie.movie_ratings(pages)


@query
def movie_content(spark, sf):
    info = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("overview"),
        F.concat(text("p_size"), F.lit("85-01-31")).alias("release_date"),
        F.col("p_name").alias("original_title"),
    )
    return movie.movie_content(info)


@query
def anime_ratings(spark, sf):
    lists = table(spark, sf, "events").select(
        text("user_id").alias("user_id"),
        F.col("event_id").alias("anime_id"),
        F.floor("value").alias("score"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("updated_at"),
    )
    return anime.anime_ratings(lists)


@query
def anime_content(spark, sf):
    record = F.to_json(F.struct(F.struct(
        F.col("p_partkey").alias("mal_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("synopsis"),
        F.struct(F.struct(F.struct(
            F.when(F.col("p_size") > 9, F.col("p_size") + 1970).alias("year")
        ).alias("from")).alias("prop")).alias("aired"),
    ).alias("data")))
    parsed = F.from_json(record, S.ANIME_INFO)
    return anime.anime_content(table(spark, sf, "part").select(parsed.alias("r")).select("r.*"))


@query
def videogame_ratings(spark, sf):
    """Owned games and profiles as JSON keyed by account; every seventh account's profile is
    empty, others lack a name."""
    bought = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    games = bought.select(F.concat(
        F.lit("[{\""), text("o_custkey"), F.lit("\":"),
        F.to_json(F.array(F.struct(
            F.col("l_partkey").alias("appid"),
            (F.col("l_quantity").cast("bigint") - 1).alias("playtime_forever"),
        ))),
        F.lit("}]"),
    ).alias("doc"))
    name = F.when(F.col("c_nationkey") < 5, F.lit("{}")).when(
        F.col("c_nationkey") < 10, F.lit("{\"id\":1}")
    ).otherwise(F.concat(F.lit("{\"personaname\":\""), "c_name", F.lit("\"}")))
    people = table(spark, sf, "customer").select(F.concat(
        F.lit("[{\""), text("c_custkey"), F.lit("\":"), name, F.lit("}]")
    ).alias("doc"))
    return videogame.videogame_ratings(
        keyed_list_entries(games, "doc", S.GAMES_PLAYED),
        keyed_list_entries(people, "doc", S.PROFILE),
    )


@query
def videogame_content(spark, sf):
    released = F.when(F.col("p_size") < 10, F.lit("Coming soon")).otherwise(
        F.concat(F.lit("Oct 21, 19"), text("p_size"))
    )
    docs = table(spark, sf, "part").select(F.concat(
        F.lit("{\""), text("p_partkey"), F.lit("\":"),
        F.to_json(F.struct(
            F.col("p_name").alias("name"),
            released.alias("release_date"),
            F.when(F.col("p_size") > 20, F.col("p_brand")).alias("detailed_description"),
        )),
        F.lit("}"),
    ).alias("doc"))
    return videogame.videogame_content(keyed_entries(docs, "doc", S.GAME_INFO))


@query
def boardgame_ratings(spark, sf):
    """Collections as XML text, one item per order line."""
    value = F.when(F.col("playtime") > 40, F.lit("N/A")).otherwise(text("playtime"))
    doc = F.concat(
        F.lit("<items><item objectid=\""), "content_id", F.lit("\"><name>x</name><stats><rating value=\""),
        value, F.lit("\"/></stats><status lastmodified=\""),
        F.date_format("rating_date", "yyyy-MM-dd HH:mm:ss"), F.lit("\"/></item></items>"),
    )
    parsed = F.from_xml(doc, f"item array<{S.COLLECTION_ITEM}>", {"rowTag": "items"})
    items = plays(spark, sf).select("user_id", F.explode(parsed["item"]).alias("item"))
    return collection_ratings(items)


@query
def boardgame_content(spark, sf):
    doc = F.concat(
        F.lit("<items><item><name type=\"alternate\" value=\"other\"/><name type=\"primary\" value=\""),
        "p_name", F.lit("\"/><description>"), "p_brand", F.lit(" &amp;amp; more</description><yearpublished value=\""),
        text("p_size"), F.lit("\"/></item></items>"),
    )
    parsed = F.from_xml(doc, f"item array<{S.CATALOGUE_ITEM}>", {"rowTag": "items"})
    items = table(spark, sf, "part").select(
        text("p_partkey").alias("content_id"), F.explode(parsed["item"]).alias("item")
    )
    return catalogue_content(items)


@query
def boardgame_reviews(spark, sf):
    """Review pages as XML text, one comment each."""
    doc = F.concat(
        F.lit("<items><item><comments totalitems=\"1\"><comment username=\""), "user_id",
        F.lit("\" rating=\""), F.when(F.col("playtime") > 40, "N/A").otherwise(text("playtime")),
        F.lit("\"/></comments></item></items>"),
    )
    parsed = F.from_xml(doc, S.REVIEW_PAGE, {"rowTag": "items"})
    items = plays(spark, sf).select(
        F.col("content_id").alias("game_id"), F.explode(parsed["item"]).alias("item")
    )
    return review_comments(items)


@query
def anime_reviews(spark, sf):
    review = F.struct(F.array(F.struct(F.struct(F.col("user_id").alias("username")).alias("user"))).alias("data"))
    docs = plays(spark, sf).select(
        F.col("content_id").alias("anime_id"), F.from_json(F.to_json(review), S.ANIME_REVIEWS).alias("r")
    )
    return reviewers(docs.select("anime_id", "r.data"))


@query
def id_export(spark, sf):
    """Part ids written as gzip JSON Lines and read back."""
    path = scratch_path(spark, "export")
    ids = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_name")
    ids.write.option("compression", "gzip").json(path)
    return read_id_export(spark, path)


@query
def latest_snapshot(spark, sf):
    """Two dated tables of which the newer one counts."""
    base = scratch_path(spark, "snapshots")
    write_zone(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), f"{base}/raw_movies_2023-12-31.parquet")
    write_zone(table(spark, sf, "part").select(F.col("p_partkey").alias("id")), f"{base}/raw_movies_2024-01-02.parquet")
    return read_latest_snapshot(spark, base)


# --- edges and nodes -----------------------------------------------------------------------------

@query
def user_content(spark, sf):
    return edges.user_content(merged(spark, sf), content(spark, sf))


@query
def user_content_right(spark, sf):
    """Event ratings know only some of the content, so unmatched rows appear."""
    some = event_ratings(spark, sf).withColumn("type", F.lit(KIND))
    return edges.user_content(merge.merge_ratings(some), content(spark, sf), how="right")


@query
def rating_edges(spark, sf):
    return rating_edge_table(spark, sf)


@query
def keyword_edges(spark, sf):
    return keyword_edge_table(spark, sf)


@query
def keyword_edges_of_incomplete_rows(spark, sf):
    """Rows without an id, a type or a keyword give no edge, and no node further on."""
    number = F.col("content_id").cast("int")
    some = title_keywords(spark, sf).select(
        F.when(number % 5 != 0, F.col("content_id")).alias("content_id"),
        F.when(number % 7 != 0, F.col("type")).alias("type"),
        F.when(F.length("keyword") > 4, F.col("keyword")).alias("keyword"),
    )
    linked = edges.project_undirected(edges.edges_has_keyword(some).unionByName(some.select(
        F.col("content_id").alias("src_id"), F.col("type").alias("src_type"), F.lit("has_keyword").alias("rel"),
        F.lit(None).cast("string").alias("dst_id"), F.lit(None).cast("string").alias("dst_type"),
    )))
    return nodes.split_node_id(linked.withColumnRenamed("src", "node")).select("label", "type", "key", "dst")


@query
def undirected_graph(spark, sf):
    both = rating_edge_table(spark, sf).unionByName(keyword_edge_table(spark, sf))
    return edges.project_undirected(both)


@query
def node_tables(spark, sf):
    """All node tables in one list; users of all domains linked."""
    t = nodes.build_nodes(
        content(spark, sf), ratings(spark, sf), title_keywords(spark, sf), link_users=True
    )
    return (
        t["content"].select(F.lit("content").alias("label"), F.col("content_id").alias("key"), "type", "title")
        .unionByName(t["users"].select(F.lit("users").alias("label"), F.col("user_id").alias("key"), "type"), True)
        .unionByName(t["keyword"].select(F.lit("keyword").alias("label"), F.col("keywords").alias("key")), True)
    )


@query
def upsert_nodes(spark, sf):
    """Prices and sizes of all parts, then a second load in which large sizes are unknown."""
    old = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    sold = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    new = sold.groupBy("p_partkey").agg(F.max("l_quantity").cast("int").alias("best"))
    new = new.select("p_partkey", F.when(F.col("best") < 50, F.col("best")).alias("p_size"))
    return nodes.upsert_nodes(old, new, ["p_partkey"])


@query
def upsert_last_row(spark, sf):
    """Every sale as a new row of its part: the last one counts, as a whole."""
    old = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    sold = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale"),
        F.when(F.col("l_quantity") < 30, F.col("l_quantity").cast("int")).alias("p_size"),
        F.col("l_discount").alias("discount"),
    )
    return nodes.upsert_nodes(old.withColumn("sale", F.lit(0).cast("bigint")), sold, ["p_partkey"], "sale")


@query
def upsert_bucketed(spark, sf):
    """The loads of ``upsert_nodes`` into a zone of buckets, the second one in two parts."""
    path = scratch_path(spark, "buckets")
    old = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    upsert_into_buckets(old, path, ["p_partkey"], buckets=16)
    sold = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    new = sold.groupBy("p_partkey").agg(F.max("l_quantity").cast("int").alias("best"))
    new = new.select("p_partkey", F.when(F.col("best") < 50, F.col("best")).alias("p_size"))
    for part in (0, 1):
        upsert_into_buckets(new.filter(F.col("p_partkey") % 2 == part), path, ["p_partkey"])
    return read_bucketed(spark, path)


@query
def frontier(spark, sf):
    """Documents not labelled yet."""
    return incremental.frontier(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query
def frontier_stored(spark, sf):
    """Documents not labelled yet, against labels stored in two loads in buckets by id."""
    name = f"fetched_{uuid.uuid4().hex}"
    labels = table(spark, sf, "labels")
    for half in (0, 1):
        incremental.store_keys(labels.filter(F.col("doc_id") % 2 == half), "doc_id", name)
    return incremental.frontier_of_stored(table(spark, sf, "documents"), name, "doc_id")


@query
def high_water_mark(spark, sf):
    return incremental.high_water_mark(table(spark, sf, "orders"), "o_orderkey")


@query
def distinct_raters(spark, sf):
    return profile.distinct_raters(plays(spark, sf), "content_id", "user_id")


@query
def page_count(spark, sf):
    totals = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("total"))
    return totals.select("l_suppkey", fn.page_count(F.col("total")).alias("pages"))


# --- charts and recommendation -------------------------------------------------------------------

@query
def liker_count(spark, sf):
    return charts.liker_count(rating_edge_table(spark, sf), CONTENT_ID, KIND)


@query
def content_likers(spark, sf):
    return charts.likers(rating_edge_table(spark, sf))


@query
def top_by_popularity(spark, sf):
    return charts.top_by_popularity(rating_edge_table(spark, sf), content(spark, sf))


@query
def find_content(spark, sf):
    return recommend.find_content(content(spark, sf), TEXT, KIND)


@query
def find_content_any_kind(spark, sf):
    return recommend.find_content(content(spark, sf), TEXT)


@query
def find_contents(spark, sf):
    """The first match of many texts: pieces of titles, some short, some of a given type, some in no title."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", F.lower("p_type").alias("kind"))
    n = F.col("p_partkey")
    piece = F.when(n % 11 == 0, F.concat(F.lit("no "), "p_name")).when(n % 7 == 0, F.upper(F.substring("p_name", 2, 2))).when(
        n % 13 == 0, F.left("p_name", F.lit(1))).when(n % 17 == 0, F.lit("")).otherwise(F.substring("p_name", 3, 6))
    texts = parts.select("p_partkey", piece.alias("text"), F.when(n % 3 == 0, F.col("kind")).alias("kind"))
    return titles.find_contents(content(spark, sf), texts, kind="kind")


@query
def similar_content(spark, sf):
    return recommend.similar_content(vectors(spark, sf), best_title(spark, sf), KINDS, k=8)


def every_fiftieth(v: DataFrame) -> DataFrame:
    return v.filter(F.col("content_id").cast("bigint") % 50 == 0)


@query
def similar_content_batch(spark, sf):
    """Every content whose id is divisible by 50 as origin, against all."""
    v = vectors(spark, sf)
    return recommend.similar_content_batch(v, every_fiftieth(v), KINDS, k=2)


@query
def similar_content_all_lists(spark, sf):
    """The same through an index of which every list is looked through: nothing is missing in it."""
    v = vectors(spark, sf)
    index = vector_index.build_index(v, scratch_path(spark, "index"), KINDS, k=2)
    return vector_index.search_index(index, v, every_fiftieth(v), KINDS, k=2, probes=len(index.sizes))


@query
def similar_content_recall(spark, sf):
    """The same through the lists that the index chooses to look through: how much of the exact answer is found."""
    v = vectors(spark, sf)
    index = vector_index.build_index(v, scratch_path(spark, "index"), KINDS, k=2)
    found = vector_index.search_index(index, v, every_fiftieth(v), KINDS, k=2)
    exact = recommend.similar_content_batch(v, every_fiftieth(v), KINDS, k=2)
    return vector_index.recall_of(found, exact).select("origins", "wanted", (F.col("recall") >= 0.9).alias("enough"))


@query
def similar_with_keywords(spark, sf):
    found = recommend.similar_with_keywords(
        vectors(spark, sf), keyword_edge_table(spark, sf), best_title(spark, sf), KINDS
    )
    return found.withColumn("keywords", fn.keyword_line("keywords"))


@query
def recommendations(spark, sf):
    found = recommend.recommend(
        vectors(spark, sf), keyword_edge_table(spark, sf), TEXT, KIND, KINDS
    )
    return found.select("kind_rank", "rank", "content_id", "type", "title", "similarity")


@query
def content_profile(spark, sf):
    found = recommend.content_profile(
        content(spark, sf), keyword_edge_table(spark, sf), CONTENT_ID, KIND
    )
    return found.withColumn("keywords", fn.keyword_line("keywords"))


# --- keywords ------------------------------------------------------------------------------------

@query
def top_keywords(spark, sf):
    return keywords.top_keywords(table(spark, sf, "documents"), ["doc_id"], "text")


@query
def top_keywords_all_spellings(spark, sf):
    return keywords.top_keywords(table(spark, sf, "documents"), ["doc_id"], "text", dedup=None)


@query
def keyword_columns(spark, sf):
    found = keywords.top_keywords(table(spark, sf, "documents"), ["doc_id"], "text")
    return keywords.keyword_columns(found, ["doc_id"])


# --- graph scores --------------------------------------------------------------------------------

@query
def page_rank(spark, sf):
    with graph(spark, sf) as g:
        return centrality.page_rank(g).select("node", rounded("pagerank"))


@query
def article_rank(spark, sf):
    with graph(spark, sf) as g:
        return centrality.article_rank(g).select("node", rounded("centrality"))


@query
def both_ranks(spark, sf):
    """In the same rounds."""
    with graph(spark, sf) as g:
        return centrality.ranks(g).select("node", rounded("pagerank"), rounded("centrality"))


@query
def both_ranks_settled(spark, sf):
    """Until no score moves by more than a fiftieth."""
    with graph(spark, sf) as g:
        found = centrality.settled_ranks(g, tolerance=0.02)
    return found.select("node", rounded("pagerank"), rounded("centrality"))


def scored(spark, sf) -> DataFrame:
    with graph(spark, sf) as g:
        ranks = nodes.content_property(centrality.page_rank(g), "pagerank")
    return nodes.attach_node_property(content(spark, sf), ranks, ["content_id", "type"])


@query
def users_with_embedding(spark, sf):
    """Written back to user nodes only, linked or not."""
    rated = stored(spark, rated_content(spark, sf), "rated")
    with graph(spark, sf, rated) as g:
        found = nodes.split_node_id(embedding.fast_rp(g, dim=8)).withColumnRenamed("key", "user_id")
    both = rated.select("user_id", "type").distinct().unionByName(content(spark, sf).select(F.col("content_id").alias("user_id"), F.lit("none").alias("type")))
    kept = nodes.attach_node_property(both, found, ["user_id", "type"], labels=("users",))
    return kept.select("user_id", "type", F.size("embedding").alias("width"), (fn.vector_sum(F.col("embedding")) == 0).cast("int").alias("zero"))


@query
def node_property(spark, sf):
    return scored(spark, sf).select("content_id", "type", rounded("pagerank"))


@query
def top_by_pagerank(spark, sf):
    return charts.top_by_pagerank(scored(spark, sf)).select(
        "content_id", "type", "title", "pagerank", "rank"
    )


@query
def fast_rp(spark, sf):
    with graph(spark, sf) as g:
        found = embedding.fast_rp(g)
    millionths = F.transform("embedding", lambda x: F.round(x * 1e6).cast("bigint").cast("string"))
    return found.select("node", F.array_join(millionths, " ").alias("embedding"))


# --- sinks and streaming -------------------------------------------------------------------------

@query
def zone_roundtrip(spark, sf):
    """Written by domain and read back."""
    return publish(content(spark, sf), scratch_path(spark, "zone"), "merged")


@query
def ingest_events(spark, sf):
    """The events file read as a stream of new files and merged by user."""
    base = scratch_path(spark, "ingest")

    def normalise(batch: DataFrame) -> DataFrame:
        return batch.groupBy("user_id").agg(
            F.max("event_id").alias("event_id"), F.count(F.lit(1)).alias("events")
        )

    ingest_new_files(
        spark, sf, f"{base}/checkpoint", normalise, f"{base}/rows",
        table(spark, sf, "events").schema, pathGlobFilter="events.parquet",
    )
    return read_ingested(spark, f"{base}/rows", ["user_id"])


@query
def ingest_two_batches(spark, sf):
    """Two files, read in two runs. A user has many rows in each, some without a value; the last one
    counts, and what it lacks comes from the batch before."""
    base = scratch_path(spark, "batches")
    rows = table(spark, sf, "events").select(
        "user_id", "event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value")
    )
    for half in (0, 1):
        mine = rows.filter((F.col("event_id") % 2 == half) & ((F.col("user_id") % 3 != 0) | F.lit(half == 0)))
        write_zone(mine, f"{base}/in/half={half}")
        ingest_new_files(
            spark, f"{base}/in/half=*", f"{base}/checkpoint", lambda batch: batch, f"{base}/rows", rows.schema
        )
    return read_ingested(spark, f"{base}/rows", ["user_id"])


@query
def ingest_compacted(spark, sf):
    """Four files in four runs; the first two are folded into a base, then these and the third, and what is
    folded is removed."""
    base = scratch_path(spark, "compacted")
    rows = table(spark, sf, "events").select(
        "user_id", "event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("event_type"),
    )
    for part in range(4):
        mine = rows.filter((F.col("event_id") % 4 == part) & (F.col("user_id") % (part + 2) != 0))
        write_zone(mine, f"{base}/in/part={part}")
        ingest_new_files(
            spark, f"{base}/in/part=*", f"{base}/checkpoint", lambda batch: batch, f"{base}/rows", rows.schema
        )
        if part in (1, 2):
            compact_ingested(spark, f"{base}/rows", ["user_id"])
    drop_folded(spark, f"{base}/rows", bases=1)
    return read_ingested(spark, f"{base}/rows", ["user_id"])


@query
def zone_variants(spark, sf):
    """Two folders, one written as a single file, read in one scan; a third write is refused."""
    base = scratch_path(spark, "variants")
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    write_zone(parts.filter("p_partkey % 2 = 0").repartition(4), f"{base}/a", files=1)
    write_zone(parts.filter("p_partkey % 2 = 1"), f"{base}/b", mode="errorifexists")
    try:
        write_zone(parts, f"{base}/b", mode="errorifexists")
        refused = False
    except AnalysisException:
        refused = True
    file = F.input_file_name()
    both = read_parquet_many(spark, [f"{base}/a", f"{base}/b"]).select(
        "p_partkey", F.regexp_extract(file, "/([ab])/[^/]+$", 1).alias("folder"), file.alias("file")
    )
    return both.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("keys"),
        (F.count_distinct(F.when(F.col("folder") == "a", F.col("file"))) <= 1).alias("one_file"),
    ).withColumn("refused", F.lit(refused))


# --- files of other systems ----------------------------------------------------------------------

def files_by(spark, name: str, docs: DataFrame, key: str = "key") -> str:
    """One text file per key, in a folder named by it, where odd characters are encoded."""
    path = scratch_path(spark, name)
    write_documents(docs, path, key)
    return path


def odd(name: str):
    """An id with characters that paths encode."""
    return F.concat(F.lit("nr +%"), text(name))


IN_FOLDER = r"/key=([^/]+)/[^/]+$"


def once_decoded(c: str):
    """Folder names are encoded twice: by the writer of partitions, then as part of a URI."""
    return F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B"))).alias(c)


def collection_folder(spark, sf) -> str:
    """A collection per supplier; one file is broken."""
    item = F.concat(
        F.lit("<item objectid=\""), text("l_partkey"), F.lit("\"><name>x</name><stats><rating value=\""),
        F.when(F.col("l_quantity") > 40, F.lit("N/A")).otherwise(text("l_quantity")),
        F.lit("\"/></stats><status lastmodified=\"2020-01-02 03:04:05\"/></item>"),
    )
    docs = table(spark, sf, "lineitem").groupBy(odd("l_suppkey").alias("key")).agg(
        F.concat(F.lit("<items>"), F.array_join(F.collect_list(item), ""), F.lit("</items>")).alias("doc")
    )
    broken = F.when(F.col("key") == "nr +%1", F.substr("doc", F.lit(1), F.length("doc") - 3)).otherwise(F.col("doc"))
    return files_by(spark, "collections", docs.select("key", broken.alias("doc")))


@query
def collections_files(spark, sf):
    found = read_collections_xml(spark, collection_folder(spark, sf), glob="*.txt", key=IN_FOLDER)
    return found.withColumn("user_id", once_decoded("user_id"))


@query
def collections_checked(spark, sf):
    """The same ratings from a reader that keeps the bad files."""
    store = scratch_path(spark, "checked")
    found = read_collections_checked(spark, collection_folder(spark, sf), store, glob="*.txt", key=IN_FOLDER)
    return found.good.withColumn("user_id", once_decoded("user_id"))


def rejects(found) -> DataFrame:
    """The bad documents with the folder's key, the reason and the counts of the one scan."""
    key = F.regexp_extract("file", IN_FOLDER, 1).alias("key")
    counts = [F.lit(n).cast("bigint").alias(name) for n, name in ((found.n_good, "n_good"), (found.n_bad, "n_bad"))]
    return found.bad.select(key, "reason").select(once_decoded("key"), "reason", *counts)


@query
def collections_rejects(spark, sf):
    store = scratch_path(spark, "checked")
    return rejects(read_collections_checked(spark, collection_folder(spark, sf), store, glob="*.txt", key=IN_FOLDER))


@query
def catalogue_files(spark, sf):
    item = F.concat(
        F.lit("<item><name type=\"primary\" value=\""), "p_name", F.lit("\"/><description>"), "p_brand",
        F.lit(" &amp;amp; more</description><yearpublished value=\""), text("p_size"), F.lit("\"/></item>"),
    )
    docs = table(spark, sf, "part").groupBy(odd("p_brand").alias("key")).agg(
        F.concat(F.lit("<items>"), F.array_join(F.collect_list(item), ""), F.lit("</items>")).alias("doc")
    )
    found = read_catalogue_xml(spark, files_by(spark, "catalogue", docs), glob="*.txt", key=IN_FOLDER)
    return found.withColumn("content_id", once_decoded("content_id"))


@query
def review_page_files(spark, sf):
    comment = F.concat(
        F.lit("<comment username=\""), text("l_orderkey"), F.lit("\" rating=\""),
        F.when(F.col("l_quantity") > 40, F.lit("N/A")).otherwise(text("l_quantity")), F.lit("\"/>"),
    )
    docs = table(spark, sf, "lineitem").groupBy(text("l_suppkey").alias("key")).agg(F.concat(
        F.lit("<items><item><comments totalitems=\"1\">"), F.array_join(F.collect_list(comment), ""),
        F.lit("</comments></item></items>"),
    ).alias("doc"))
    return read_review_pages_xml(spark, files_by(spark, "reviews", docs), glob="*.txt", key=IN_FOLDER)


@query
def review_json_files(spark, sf):
    review = F.struct(F.struct(text("l_orderkey").alias("username")).alias("user"))
    docs = table(spark, sf, "lineitem").groupBy(text("l_suppkey").alias("key")).agg(
        F.replace(F.to_json(F.struct(F.collect_list(review).alias("data"))), F.lit("},{"), F.lit("},\n{")).alias("doc")
    )
    return read_review_json(spark, files_by(spark, "json", docs), glob="*.txt", key=IN_FOLDER)


def anime_list_folder(spark, sf) -> str:
    """A list per user as one JSON array over several lines; the first user's file is broken."""
    entry = F.struct(
        F.col("event_id").alias("anime_id"), F.floor("value").alias("score"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("updated_at"),
    )
    docs = table(spark, sf, "events").groupBy(text("user_id").alias("key")).agg(
        F.replace(F.to_json(F.collect_list(entry)), F.lit("},{"), F.lit("},\n {")).alias("doc")
    )
    broken = F.when(F.col("key") == "1", F.concat(F.lit("]"), "doc")).otherwise(F.col("doc"))
    return files_by(spark, "lists", docs.select("key", broken.alias("doc")))


@query
def anime_list_files(spark, sf):
    return anime.anime_ratings(read_anime_lists(spark, anime_list_folder(spark, sf), glob="*.txt", key=IN_FOLDER))


@query
def anime_list_rejects(spark, sf):
    store = scratch_path(spark, "checked")
    found = read_anime_lists_checked(spark, anime_list_folder(spark, sf), store, glob="*.txt", key=IN_FOLDER)
    return rejects(found)


@query
def anime_list_checked(spark, sf):
    store = scratch_path(spark, "checked")
    found = read_anime_lists_checked(spark, anime_list_folder(spark, sf), store, glob="*.txt", key=IN_FOLDER)
    return anime.anime_ratings(found.good)


@query
def anime_info_files(spark, sf):
    record = F.struct(F.struct(
        F.col("p_partkey").alias("mal_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("synopsis"),
        F.struct(F.struct(F.struct((F.col("p_size") + 1970).alias("year")).alias("from")).alias("prop")).alias("aired"),
    ).alias("data"))
    docs = table(spark, sf, "part").groupBy(F.floor(F.col("p_partkey") / 100).alias("key")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(F.to_json(record)), ",\n"), F.lit("\n]")).alias("doc")
    )
    return anime.anime_content(read_anime_info(spark, files_by(spark, "info", docs), glob="*.txt"))


def profile_lines(spark, sf) -> DataFrame:
    """Every account's profile, listed twice: the first one counts. Some first ones are empty, others
    lack a name."""
    first = F.when(F.col("c_nationkey") < 5, F.lit("{}")).when(
        F.col("c_nationkey") < 10, F.lit("{\"id\":1}")
    ).otherwise(F.concat(F.lit("{\"personaname\":\""), "c_name", F.lit("\"}")))
    people = table(spark, sf, "customer").select("c_custkey", first.alias("first"))
    line = lambda profile: F.concat(F.lit("{\""), text("c_custkey"), F.lit("\":"), profile, F.lit("}"))
    listed = people.select(F.lit(0).alias("turn"), "c_custkey", line(F.col("first")).alias("value")).unionByName(
        people.select(F.lit(1).alias("turn"), "c_custkey", line(F.lit("{\"personaname\":\"Aaa\"}")).alias("value"))
    )
    return listed.repartitionByRange(4, "turn", F.desc("c_custkey")).sortWithinPartitions("turn", F.desc("c_custkey"))


@query
def first_profiles(spark, sf):
    """From JSON Lines, over several files."""
    path = scratch_path(spark, "profiles")
    profile_lines(spark, sf).select("value").write.text(path)
    return videogame.player_names(read_keyed_json_list(spark, path, S.PROFILE))


def list_files(spark, listed: DataFrame, name: str, opens: str, closes: str) -> str:
    """Files that hold one list or object each, of up to a thousand ``value`` rows in the order of ``at``: one per ``key``."""
    docs = listed.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("rows"))
    whole = F.array_join(F.transform("rows", lambda r: r["value"]), ",\n ")
    return files_by(spark, name, docs.select("key", F.concat(F.lit(opens), whole, F.lit(closes)).alias("doc")))


@query
def first_profiles_of_an_array(spark, sf):
    """The same from files that hold a list each."""
    turn = F.when(F.col("turn") == 0, F.lit("a")).otherwise(F.lit("b"))
    number = F.col("c_custkey")
    key = F.concat(turn, F.lpad(F.floor(number / 1000).cast("string"), 12, "0"))
    listed = profile_lines(spark, sf).select(key.alias("key"), number.alias("at"), "value")
    path = list_files(spark, listed, "profiles", "[", "]")
    return videogame.player_names(read_keyed_json_list(spark, path, S.PROFILE, lines=False))


def game_entries(spark, sf) -> DataFrame:
    """``"id": {…}`` of every game, with commas, brackets, quotes and backslashes in its texts."""
    odd_name = F.concat(F.lit("a, \"b\" }] \\"), "p_name")
    record = F.to_json(F.struct(
        odd_name.alias("name"), F.lit("Oct 21, 1999").alias("release_date"), F.col("p_brand").alias("detailed_description")
    ))
    entry = F.concat(F.lit("\""), text("p_partkey"), F.lit("\":"), record)
    return table(spark, sf, "part").select(
        F.floor(F.col("p_partkey") / 1000).alias("key"), F.col("p_partkey").alias("at"), entry.alias("value")
    )


@query
def keyed_json_objects(spark, sf):
    """Files that are one object each."""
    path = list_files(spark, game_entries(spark, sf), "games", "{", "}")
    return videogame.videogame_content(read_keyed_json(spark, path, S.GAME_INFO, lines=False))


@query
def keyed_json_lines(spark, sf):
    path = scratch_path(spark, "games")
    record = F.to_json(F.struct(F.col("p_name").alias("name"), F.lit("Oct 21, 1999").alias("release_date"), F.col("p_brand").alias("detailed_description")))
    table(spark, sf, "part").select(
        F.concat(F.lit("{\""), text("p_partkey"), F.lit("\":"), record, F.lit("}")).alias("value")
    ).write.text(path)
    return videogame.videogame_content(read_keyed_json(spark, path, S.GAME_INFO))


@query
def consolidated_documents(spark, sf):
    """Small documents to one table."""
    docs = table(spark, sf, "part").groupBy("p_brand").agg(
        F.to_json(F.struct(F.col("p_brand").alias("brand"), F.count(F.lit(1)).alias("n"))).alias("doc")
    )
    path = files_by(spark, "documents", docs.withColumnRenamed("p_brand", "key"))
    found = consolidate_documents(spark, f"{path}/*", glob="*.txt")
    return found.select(F.trim(F.rtrim(F.col("json"), F.lit("\n"))).alias("json"), F.col("id").endswith(".txt").alias("named"))


@query
def videogame_variants(spark, sf):
    """Ratings by account instead of display name under another type, beside the titles of content under another
    title column."""
    games = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    owned = games.groupBy(text("o_custkey").alias("key")).agg(F.collect_list(F.struct(
        F.col("l_partkey").alias("appid"), (F.col("l_quantity").cast("bigint") - 1).alias("playtime_forever")
    )).alias("value"))
    path, parts = scratch_path(spark, "profiles"), scratch_path(spark, "games")
    profile_lines(spark, sf).select("value").write.text(path)
    profiles = read_keyed_json_list(spark, path, S.PROFILE)
    rated = videogame.videogame_ratings(owned, profiles, key="account", type_label="Steam")
    game_entries(spark, sf).select(F.concat(F.lit("{"), "value", F.lit("}"))).write.text(parts)
    listed = videogame.videogame_content(read_keyed_json(spark, parts, S.GAME_INFO), title_column="content_title")
    return rated.join(listed.select("content_id", "content_title"), "content_id").select(
        "user_id", "content_id", "rating", F.col("type").alias("type_label"), "content_title"
    )


@query
def review_totals(spark, sf):
    """The number of reviews that the first page of each game announces, as pages of a hundred."""
    page = F.concat(F.lit("<items><item><comments totalitems=\""), text("total"), F.lit("\"/></item></items>"))
    docs = table(spark, sf, "lineitem").groupBy(text("l_suppkey").alias("key")).agg(F.count(F.lit(1)).alias("total"))
    path = files_by(spark, "totals", docs.select("key", page.alias("doc")))
    totals = read_review_totals_xml(spark, path, glob="*.txt", key=IN_FOLDER)
    return totals.select("game_id", "total", fn.page_count(F.col("total")).alias("pages"))


# --- the whole build -----------------------------------------------------------------------------

@query
def recommendations_end_to_end(spark, sf):
    """From plays and descriptions to keywords, edges, our own embedding, ranks and recommendations."""
    tables = build_catalogue(spark, ratings(spark, sf), content(spark, sf), scratch_path(spark, "build"), dim=16)
    found = recommend.recommend(tables["nodes_content"], tables["edges"], TEXT, KIND, KINDS)
    ranked = tables["nodes_content"].select("content_id", "type", rounded("pagerank"), rounded("centrality"))
    return found.join(ranked, ["content_id", "type"]).select(
        "kind_rank", "rank", "content_id", "type", "title", "similarity", fn.keyword_line("keywords").alias("keywords"),
        "pagerank", "centrality",
    )
