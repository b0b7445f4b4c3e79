from kindred.functions.dates import epoch_date, first_year, iso_date, last_year
from kindred.functions.numbers import page_count, rating_bucket, two_decimals
from kindred.functions.text import (
    contains_text,
    json_default,
    keyword_line,
    normalise_user,
    null_if,
    plain_user,
    unescape_html,
)
from kindred.functions.vectors import cosine, l2_norm, vector_add, vector_sum

__all__ = [
    "contains_text", "cosine", "epoch_date", "first_year", "iso_date", "json_default",
    "keyword_line", "l2_norm", "last_year", "normalise_user", "null_if", "page_count",
    "plain_user", "rating_bucket", "two_decimals", "unescape_html", "vector_add", "vector_sum",
]
