"""Column helpers; every one is a composition of built-in expressions."""

from .conditional import flag, is_sentinel, map_values, null_if_before, null_sentinels
from .dates import (
    days_between,
    elapsed_2dp,
    month_name,
    month_of,
    parse_date,
    parse_date_in_range,
    parse_timestamp,
)
from .numbers import (
    avg_2dp,
    half_up_div,
    hundredths,
    parse_integer,
    parse_positive_int,
    parse_score,
    pct,
    ratio_avg_2dp,
)
from .text import bracketed, initcap_words, matches, norm_id, norm_key, norm_label, trimmed

__all__ = [
    "avg_2dp", "bracketed", "days_between", "elapsed_2dp", "flag", "half_up_div", "hundredths",
    "initcap_words", "is_sentinel", "map_values", "matches", "month_name", "month_of", "norm_id",
    "norm_key", "norm_label", "null_if_before", "null_sentinels", "parse_date",
    "parse_date_in_range", "parse_integer", "parse_positive_int", "parse_score", "parse_timestamp",
    "pct", "ratio_avg_2dp", "trimmed",
]
