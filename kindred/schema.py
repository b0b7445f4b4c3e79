"""The unified tables every domain is brought to, and the raw schemas read from the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# The four content domains and the order in which results list them.
KINDS = ("anime", "videogame", "boardgame", "movie")

RATINGS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("rating_date", T.TimestampType()),
])

CONTENT = T.StructType([
    T.StructField("content_id", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("title", T.StringType()),
])

REVIEWS_JSON = (
    "array<struct<author:string,author_details:struct<rating:string>,created_at:string>>"
)
ANIME_LIST = "anime_id bigint, score bigint, updated_at bigint"
ANIME_INFO = (
    "data struct<mal_id:bigint,title:string,synopsis:string,"
    "aired:struct<prop:struct<`from`:struct<year:bigint>>>>"
)
ANIME_REVIEWS = "data array<struct<user:struct<username:string>>>"
GAMES_PLAYED = "array<struct<appid:bigint,playtime_forever:bigint>>"
PROFILE = "map<string,string>"
GAME_INFO = "map<string,string>"
COLLECTION_ITEM = (
    "struct<_objectid:string,stats:struct<rating:struct<_value:string>>,"
    "status:struct<_lastmodified:string>>"
)
CATALOGUE_ITEM = (
    "struct<name:array<struct<_type:string,_value:string>>,description:string,"
    "yearpublished:struct<_value:string>>"
)
REVIEW_PAGE = (
    "item array<struct<comments:struct<_totalitems:string,"
    "comment:array<struct<_username:string,_rating:string>>>>>"
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema`` by name; a value that does not fit becomes null.

    Every branch of a union and both sides of an id join pass through here, so no result depends
    on how the session coerces types.
    """
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in schema.fields
    ])
