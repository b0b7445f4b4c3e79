"""Samples that are the same in every run: rows are drawn by a hash of their key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kindred.operators.topk import top_per_group

_DIGITS = 13  # hex digits of a draw: 52 bits, whole in a double
_SPACE = 16.0**_DIGITS


def draw(keys: list[str], seed: str | int = 0) -> Column:
    """A number in [0, 1) from the row's key: the first 13 hex digits of the md5 of ``seed:key:key…``. Null parts
    read as empty."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.conv(F.left(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), F.lit(_DIGITS)), 16, 10).cast("double") / _SPACE


def sample_n(df: DataFrame, n: int, keys: list[str], seed: str | int = 0, by: list[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows, or all where there are fewer; with ``by``, of each group (nulls are one).

    The rows of the smallest draws are taken, ties by key; of rows alike in key any may be. Every task cuts
    its own rows to ``n`` (per group) first, so no more than that is moved, however large the table or group.
    """
    order = ["__draw", *[F.col(k) for k in keys]]
    drawn = df.withColumn("__draw", draw(keys, seed))
    if by is None:
        return drawn.orderBy(*order).limit(n).drop("__draw")
    return top_per_group(drawn, by, order, n, "__rank").drop("__draw", "__rank")


def sample_fraction(df: DataFrame, fraction: float, keys: list[str], seed: str | int = 0) -> DataFrame:
    """About ``fraction`` of the rows, without a shuffle: those whose draw is below it. A smaller fraction with the
    same seed gives a part of the same rows; rows alike in key are in or out together."""
    return df.filter(draw(keys, seed) < fraction)
