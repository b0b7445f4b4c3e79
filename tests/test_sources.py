import gzip
import json

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from kindred import schema as S
from kindred import sources as src
from kindred.plans.anime import anime_content, anime_ratings
from kindred.plans.movie import movie_content, movie_ratings
from kindred.plans.videogame import player_names, videogame_content, videogame_ratings


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


COLLECTION = """<?xml version="1.0"?>
<items totalitems="4">
  <item objectid="10" collid="1"><name>A</name><yearpublished>1999</yearpublished></item>
  <item objectid="x11" collid="2"><name>B</name><stats><rating value="N/A"/></stats>
    <status lastmodified="2020-01-02 03:04:05"/></item>
  <item objectid="12" collid="3"><name>C</name><stats><rating value="7.5"><average value="1"/></rating></stats>
    <status lastmodified="2020-01-02 03:04:06"/></item>
</items>"""


def test_collections(spark, tmp_path):
    put(tmp_path / "c" / "ann.xml", COLLECTION)
    put(tmp_path / "c" / "bö b%+.xml", COLLECTION.replace("x11", "99"))
    put(tmp_path / "c" / "broken.xml", COLLECTION.replace("</items>", "<item></items>"))
    put(tmp_path / "c" / "cut.xml", COLLECTION[:-40])
    put(tmp_path / "c" / "note.txt", COLLECTION)
    got = src.read_collections_xml(spark, str(tmp_path / "c"))
    assert got.dtypes == spark.createDataFrame([], S.RATINGS).dtypes
    assert rows(got, "user_id", "content_id") == [
        ("ann", "boardgame", "10", None, None),
        ("ann", "boardgame", "12", 7.5, ts("2020-01-02 03:04:06")),
        ("ann", "boardgame", "x11", None, ts("2020-01-02 03:04:05")),
        ("bö b%+", "boardgame", "10", None, None),
        ("bö b%+", "boardgame", "12", 7.5, ts("2020-01-02 03:04:06")),
        ("bö b%+", "boardgame", "99", None, ts("2020-01-02 03:04:05")),
    ]


def test_catalogue(spark, tmp_path):
    full = """<items><item type="boardgame"><name type="alternate" value="Alt"/>
      <name type="primary" value="Main"/><description>a &amp;amp; b&amp;#10;c</description>
      <yearpublished value="-3000"/></item></items>"""
    bare = '<items><item type="boardgame"><name type="alternate" value="Alt"/></item></items>'
    put(tmp_path / "1" / "1.xml", full)
    put(tmp_path / "2" / "1.xml", bare)
    put(tmp_path / "3" / "1.xml", full.replace("Main", "Third"))
    put(tmp_path / "3" / "2.xml", full)
    got = src.read_catalogue_xml(spark, str(tmp_path))
    assert got.dtypes == spark.createDataFrame([], S.CONTENT).dtypes
    assert rows(got, "content_id") == [
        ("1", "a & b\nc", -3000, "boardgame", "Main"),
        ("2", None, None, "boardgame", None),
        ("3", "a & b\nc", -3000, "boardgame", "Third"),
    ]


def test_review_pages(spark, tmp_path):
    page = """<items><item><comments page="1" totalitems="250">
      <comment username="ann" rating="8"/><comment username="bob" rating="N/A"/></comments></item></items>"""
    put(tmp_path / "7" / "1.xml", page)
    put(tmp_path / "7" / "2.xml", page.replace("bob", "cy"))
    got = src.read_review_pages_xml(spark, str(tmp_path))
    assert rows(got.distinct(), "username") == [("7", "ann", 8.0), ("7", "bob", None), ("7", "cy", None)]
    assert rows(src.read_review_totals_xml(spark, str(tmp_path))) == [("7", 250)]


def test_anime_lists_and_info(spark, tmp_path):
    put(tmp_path / "u" / "a b+%.json", json.dumps(
        [{"anime_id": 5, "score": 9, "updated_at": 60, "more": 1}, {"anime_id": 6, "score": 0, "updated_at": None}],
        indent=1))
    put(tmp_path / "u" / "bad.json", '[{"anime_id": 5, "sco')
    got = anime_ratings(src.read_anime_lists(spark, str(tmp_path / "u")))
    assert rows(got, "content_id") == [
        ("a b+%", "anime", "5", 9.0, ts("1970-01-01 00:01:00")), ("a b+%", "anime", "6", 0.0, None)]

    def info(i, year):
        return json.dumps({"data": {"mal_id": i, "title": f"t{i}", "synopsis": "s",
                                    "aired": {"prop": {"from": {"year": year}}}}}, indent=2)
    put(tmp_path / "i" / "1.json", info(1, 1999))
    put(tmp_path / "i" / "2.json", info(2, None))
    put(tmp_path / "i" / "3.json", "{oops")
    assert rows(anime_content(src.read_anime_info(spark, str(tmp_path / "i")))) == [
        ("1", "s", 1999, "anime", "t1")]


def test_anime_reviews(spark, tmp_path):
    put(tmp_path / "30.json", json.dumps({"data": [{"user": {"username": "x"}}, {"user": {"username": "y"}}]}))
    put(tmp_path / "31.json", json.dumps({"data": []}))
    assert rows(src.read_review_json(spark, str(tmp_path)), "username") == [("30", "x"), ("30", "y")]


def test_movies(spark):
    reviews = [
        {"author": "Doe, Jane", "author_details": {"rating": "8.0", "name": "n"},
         "created_at": "2019-04-01T18:22:01.123Z"},
        {"author": None, "author_details": {"rating": None}, "created_at": "yesterday"},
        {"author": "x", "author_details": {"rating": "null"}},
    ]
    df = spark.createDataFrame(
        [(1, json.dumps(reviews)), (2, "[]"), (3, None)], "id bigint, results string")
    assert rows(movie_ratings(df), "user_id") == [
        (None, "movie", "1", None, None),
        ("Doe, Jane", "movie", "1", 8.0, ts("2019-04-01 00:00:00")),
        ("x", "movie", "1", None, None),
    ]
    info = spark.createDataFrame(
        [(1, "o", "1999-01-01", "T"), (2, None, "", "U")],
        "id bigint, overview string, release_date string, original_title string")
    assert rows(movie_content(info), "content_id") == [
        ("1", "o", 1999, "movie", "T"), ("2", None, None, "movie", "U")]


@pytest.mark.parametrize("lines", [False, True])
def test_videogames(spark, tmp_path, lines):
    games = [
        {"1": [{"appid": 10, "playtime_forever": 30}, {"appid": 11, "playtime_forever": 60},
               {"appid": 12, "playtime_forever": 90}, {"appid": 13, "playtime_forever": 0}]},
        {"2": [{"appid": 10, "playtime_forever": 900}]},
        {"3": [{"appid": 10, "playtime_forever": 5}]},
        {"4": [{"appid": 10, "playtime_forever": 5}]},
        {"5": [{"appid": 10, "playtime_forever": 5}]},
    ]
    people = [{"1": {"personaname": "Ann"}}, {"2": {}}, {"2": {"personaname": "late"}},
              {"3": {"x": "y"}}, {"4": {"personaname": "Ann"}}, {"4": {"personaname": "other"}}]

    def dump(name, docs):
        text = "\n".join(map(json.dumps, docs)) if lines else json.dumps(docs, indent=4)
        put(tmp_path / name, text)
        return str(tmp_path / name)

    g = src.read_keyed_json_list(spark, dump("g.json", games), S.GAMES_PLAYED, lines)
    p = src.read_keyed_json_list(spark, dump("p.json", people), S.PROFILE, lines)
    assert rows(player_names(p), "key") == [("1", "Ann"), ("3", "Unknown"), ("4", "Ann")]
    got = videogame_ratings(g, p).select("user_id", "content_id", "rating")
    assert rows(got, "user_id", "content_id", "rating") == [
        ("Ann", "10", 1.0), ("Ann", "10", 4.0), ("Ann", "11", 7.0), ("Ann", "12", 10.0),
        ("Unknown", "10", 10.0)]
    got = videogame_ratings(g, p, key="account", type_label="Steam")
    assert rows(got.filter("user_id = 'Ann'").select("type", "rating"), "rating") == [
        ("Steam", 4.0), ("Steam", 7.0), ("Steam", 10.0), ("Steam", 10.0)]
    assert g.count() == 5 and p.count() == 6


def test_game_catalogue(spark, tmp_path):
    games = {"10": {"name": "A", "release_date": "Oct 21, 2008", "detailed_description": "d", "tags": {"x": 1}},
             "11": {"name": None, "release_date": ""}, "12": {"release_date": "Coming soon"}}
    put(tmp_path / "games.json", json.dumps(games))
    got = videogame_content(src.read_keyed_json(spark, str(tmp_path / "games.json"), S.GAME_INFO, lines=False))
    assert rows(got, "content_id") == [
        ("10", "d", 2008, "videogame", "A"),
        ("11", "", None, "videogame", None),
        ("12", "", None, "videogame", "")]
    renamed = videogame_content(
        src.read_keyed_json(spark, str(tmp_path / "games.json"), S.GAME_INFO, lines=False), title_column="content_title")
    assert "content_title" in renamed.columns


def test_exports_snapshots_and_consolidation(spark, tmp_path):
    with gzip.open(tmp_path / "movie_ids.json.gz", "wt") as f:
        f.write('{"id": 3, "x": 1}\n{"id": 4}\n')
    ids = src.read_id_export(spark, str(tmp_path / "movie_ids.json.gz"))
    assert rows(ids, "id") == [(3,), (4,)]
    pytest.importorskip("pyarrow")
    import pandas as pd
    for day, i in (("2024-01-09", 1), ("2024-02-01", 2)):
        pd.DataFrame({"id": [i]}).to_parquet(tmp_path / f"raw_movies_{day}.parquet")
    assert rows(src.read_latest_snapshot(spark, str(tmp_path))) == [(2,)]
    with pytest.raises(Exception):
        src.read_latest_snapshot(spark, str(tmp_path), prefix="none_").collect()
    put(tmp_path / "docs" / "a b.json", '{"x":\n 1}')
    put(tmp_path / "docs" / "skip.txt", "no")
    assert rows(src.consolidate_documents(spark, str(tmp_path / "docs"))) == [("a b.json", '{"x":\n 1}')]


def _odd_value(draw, depth=0):
    kinds = ["text", "number", "null", "list", "object"] if depth < 3 else ["text", "number"]
    kind = draw.choice(kinds)
    if kind == "text":
        return "".join(draw.choice('a,"\\{}[]:é日 \n') for _ in range(draw.randint(0, 30)))
    if kind == "list":
        return [_odd_value(draw, depth + 1) for _ in range(draw.randint(0, 5))]
    if kind == "object":
        return {f'k{i},"}}': _odd_value(draw, depth + 1) for i in range(draw.randint(0, 5))}
    return draw.randint(-9, 99) if kind == "number" else None


@pytest.fixture
def small_splits(spark):
    was = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in was.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("form", [{}, {"indent": 2}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_large_files_are_cut_by_several_tasks(spark, tmp_path, small_splits, form):
    import random

    draw = random.Random(4)
    table = {f'id "{i}",': _odd_value(draw) for i in range(150)}
    table['id "long",'] = ['x,"]}' * 400, {"a": [1] * 300}]  # goes over several splits
    put(tmp_path / "object" / "a.json", json.dumps(table, **form))
    listed = [{k: v} for k, v in table.items()]
    put(tmp_path / "list" / "b.json", json.dumps(listed[::-1], **form) + "\n")
    put(tmp_path / "list" / "a.json", " \n" + json.dumps(listed, **form))
    put(tmp_path / "list" / "c.json", "[]")
    put(tmp_path / "lines" / "a.json", "\n".join(map(json.dumps, listed)))
    put(tmp_path / "lines" / "b.json", "\n".join(map(json.dumps, listed[::-1])))
    from kindred.sources.json_entries import read_entries

    read = read_entries(spark, str(tmp_path / "object"))
    got = [json.loads("{" + r["value"] + "}") for r in read.orderBy("place").collect()]
    assert got == listed
    assert spark.read.option("lineSep", ",").text(str(tmp_path / "object")).rdd.getNumPartitions() > 20
    got = [json.loads(r["value"]) for r in read_entries(spark, str(tmp_path / "list")).orderBy("place").collect()]
    assert got == listed + listed[::-1]

    by_key = src.read_keyed_json(spark, str(tmp_path / "object"), "string", lines=False)
    assert rows(by_key, "key") == rows(src.read_keyed_json(spark, str(tmp_path / "lines" / "a.json"), "string"), "key")
    whole = src.read_keyed_json_list(spark, str(tmp_path / "list"), "string", lines=False)
    lines = src.read_keyed_json_list(spark, str(tmp_path / "lines"), "string")
    assert rows(whole.orderBy("position").select("key", "value")) == rows(lines.orderBy("position").select("key", "value"))


def test_files_without_entries(spark, tmp_path, small_splits):
    from kindred.sources.json_entries import read_entries

    for name, text in {"a": "[]", "b": " { } ", "c": "", "d": "[1]", "e": '{"k": "v"}', "f": "﻿[2, 3]"}.items():
        put(tmp_path / f"{name}.json", text)
    got = rows(read_entries(spark, str(tmp_path)).orderBy("place").select(F.trim("value")))
    assert got == [("1",), ('"k": "v"',), ("2",), ("3",)]
    put(tmp_path / "bad" / "x.json", '{"a": 1, "b" 2, "c": 3}')
    assert rows(src.read_keyed_json(spark, str(tmp_path / "bad"), "int", lines=False), "key") == [("a", 1), ("c", 3)]
