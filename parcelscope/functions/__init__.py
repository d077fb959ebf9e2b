"""Column-expression builders (built-in Spark functions only)."""

from parcelscope.functions.numbers import (
    currency_text, estimate_margin_text, money_avg, money_cents, money_sum, first_match, first_match_count, housing_mix, mode_shares,
    null_if_missing, parse_double, parse_int, parse_long, percent_text, ratio,
    ratio_text, sentinel_zero, share_with_guard,
)
from parcelscope.functions.text import (
    QUOTE_AWARE_COMMA, clean_key, csv_fields, lower_label, null_label, pick,
    render_pairs, split_pick, split_quoted, strip_quotes, strip_suffix,
)

__all__ = [
    "QUOTE_AWARE_COMMA", "clean_key", "csv_fields", "currency_text",
    "estimate_margin_text", "first_match", "first_match_count", "housing_mix", "lower_label",
    "mode_shares", "money_avg", "money_cents", "money_sum", "null_if_missing", "null_label", "parse_double", "parse_int",
    "parse_long", "percent_text", "pick", "ratio", "ratio_text", "render_pairs",
    "sentinel_zero", "share_with_guard", "split_pick", "split_quoted",
    "strip_quotes", "strip_suffix",
]
