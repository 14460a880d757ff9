"""Scalar column expressions (JVM-side, no Python UDFs)."""

from rawhouse.functions.labels import PITCH_CLASSES, decode_code, flag_label, trend_label
from rawhouse.functions.mapping import EXCHANGE_NAMES, country_codes, map_or_keep
from rawhouse.functions.text import (
    NULL_TOKENS,
    after_last,
    before_last,
    int_flag,
    null_if_token,
    parse_date,
    parse_timestamp,
    pct_change,
    reciprocal_fill,
    split_get,
    title_case,
)

__all__ = [
    "PITCH_CLASSES", "decode_code", "flag_label", "trend_label",
    "EXCHANGE_NAMES", "country_codes", "map_or_keep",
    "NULL_TOKENS", "after_last", "before_last", "int_flag", "null_if_token",
    "parse_date", "parse_timestamp", "pct_change", "reciprocal_fill", "split_get",
    "title_case",
]
