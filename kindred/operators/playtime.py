"""Ratings from playing time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import MapType

from kindred.functions.numbers import rating_bucket

SALTS = 4096
_SALT, _BEST, _ROW = "__salt", "__best", "__row"


def normalise_playtime(df: DataFrame, key: str = "user_id", value: str = "playtime") -> DataFrame:
    """Replace ``value`` by ``rating``: its share of the user's largest value, 1..10; rows without
    playing time or user are left out.

    The rows are moved once, by user and salt, so that no task gets all rows of a user. Each salt's
    largest value is then the only thing that users share: those meet per user, at most ``SALTS``
    rows, and go back to the salts.
    """
    played = df.filter((F.col(value) > 0) & F.col(key).isNotNull())
    hashed = [f.name for f in df.schema if not isinstance(f.dataType, MapType)]
    # Never null, which spares the join a filter that would set its side apart from the other.
    salt = F.coalesce(F.pmod(F.xxhash64(*hashed), F.lit(SALTS)), F.lit(0))
    moved = played.withColumn(_SALT, salt).repartition(key, _SALT)
    # The largest row as a whole: with the same columns below, both uses read the same exchange.
    largest = moved.groupBy(key, _SALT).agg(F.max(F.struct(value, *[c for c in df.columns if c != value])).alias(_ROW))
    best = F.max(F.col(_ROW)[value]).over(Window.partitionBy(key))
    rated = moved.join(largest.select(key, _SALT, best.alias(_BEST)), [key, _SALT])
    return rated.select(
        *[c for c in df.columns if c != value], rating_bucket(F.col(value), F.col(_BEST)).alias("rating")
    )
