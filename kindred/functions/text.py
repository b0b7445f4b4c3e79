"""String expressions over columns."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_user(c: Column | str) -> Column:
    """Lower case without outer spaces: the key under which one user's ratings meet."""
    return F.trim(F.lower(_col(c)))


def plain_user(c: Column | str) -> Column:
    """Letters and digits only, to match one user name across domains."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]", "")


def null_if(c: Column | str, *sentinels: str) -> Column:
    """Null for any of the given placeholder texts (``N/A`` and the like)."""
    c = _col(c)
    return F.when(~c.isin(*sentinels), c)


def json_default(record: Column | str, key: str, default: str) -> Column:
    """``record[key]``, or ``default`` when the key is absent; an explicit null stays null."""
    record = _col(record)
    return F.when(F.map_contains_key(record, key), record[key]).otherwise(F.lit(default))


def contains_text(c: Column | str, text: str) -> Column:
    """Case-insensitive substring test; no pattern characters."""
    return F.contains(F.lower(_col(c)), F.lower(F.lit(text)))


def keyword_line(keywords: Column | str) -> Column:
    """``['space war','ship']`` as ``Space war, Ship``."""
    return F.array_join(
        F.transform(
            _col(keywords),
            lambda k: F.concat(F.upper(F.left(k, F.lit(1))), F.lower(F.substr(k, F.lit(2)))),
        ),
        ", ",
    )


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape_html(c: Column | str) -> Column:
    """Decode every HTML entity; Spark has no such built-in. Only texts with an ``&`` are sent to
    Python, in Arrow batches."""
    c = _col(c)
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)
