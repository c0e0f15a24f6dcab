"""Column-level functions (no UDFs): text, keys and hashing, dates."""

from layerkit.functions.dates import day_name, is_weekend, iso_week, parse_ts, week_start
from layerkit.functions.keys import business_key, indicator, mask
from layerkit.functions.text import (
    contains_any,
    first_word,
    full_match,
    hits,
    normalise,
    phrase_hits,
    token_set,
)

__all__ = [
    "business_key", "contains_any", "day_name", "first_word", "full_match", "hits",
    "indicator", "is_weekend", "iso_week", "mask", "normalise", "parse_ts",
    "phrase_hits", "token_set", "week_start",
]
