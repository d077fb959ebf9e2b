"""Column expressions that turn census text into typed numbers.

Spark runs with ANSI mode on, so a bad cast or a division by zero throws.
The ``strict=False`` default of the parsers uses ``try_cast`` and the ratio
helpers use ``try_divide``: malformed text and zero denominators become NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelscope.functions._util import as_col
from parcelscope.functions.text import strip_quotes

# The texts the census tables use for a missing number.
MISSING_TEXTS = ("N", "null")


def _cast(c: Column, to: str, strict: bool) -> Column:
    return c.cast(to) if strict else c.try_cast(to)


def parse_int(col, strict: bool = False) -> Column:
    """Quoted integer text -> int (quotes stripped, blanks trimmed)."""
    return _cast(F.trim(strip_quotes(col)), "int", strict)


def parse_long(col, strict: bool = False) -> Column:
    return _cast(F.trim(strip_quotes(col)), "bigint", strict)


def parse_double(col, strict: bool = False) -> Column:
    """P10: quoted decimal text -> double."""
    return _cast(F.trim(strip_quotes(col)), "double", strict)


def null_if_missing(col) -> Column:
    """``N`` / ``null`` / empty text -> SQL NULL, else the text itself."""
    c = F.trim(as_col(col))
    return F.when(c.isin(*MISSING_TEXTS) | (c == ""), F.lit(None).cast("string")).otherwise(c)


def sentinel_zero(col) -> Column:
    """A missing-number text (or anything unparsable) -> 0.0."""
    return F.coalesce(null_if_missing(strip_quotes(col)).try_cast("double"), F.lit(0.0))


def ratio(part, total) -> Column:
    """Part / total as double; NULL when the total is 0 or NULL."""
    return F.try_divide(as_col(part).cast("double"), as_col(total).cast("double"))


def share_with_guard(part, total, default_total: float = 1.0) -> Column:
    """Part / total where a missing total counts as ``default_total``."""
    t = F.coalesce(as_col(total).cast("double"), F.lit(default_total))
    return F.try_divide(as_col(part).cast("double"), t)


def estimate_margin_text(value, margin, sign: str = "±") -> Column:
    """Render ``value±margin`` (``±`` is U+00B1)."""
    return F.concat(as_col(value).cast("string"), F.lit(sign), as_col(margin).cast("string"))


def percent_text(col) -> Column:
    """P20: ``3.19%`` -> 0.0319."""
    num = F.regexp_replace(F.trim(strip_quotes(col)), "%", "").try_cast("double")
    return num / F.lit(100.0)


def currency_text(col) -> Column:
    """``$91,534.85`` -> 91534.85 (every char but digits and dot dropped)."""
    return F.regexp_replace(as_col(col), r"[^0-9.]", "").try_cast("double")


def ratio_text(col, per: float = 1000.0) -> Column:
    """``42/1000`` -> rate per ``per`` (42.0)."""
    c = F.trim(strip_quotes(col))
    num = F.split_part(c, F.lit("/"), F.lit(1)).try_cast("double")
    den = F.split_part(c, F.lit("/"), F.lit(2)).try_cast("double")
    return F.try_divide(num, den) * F.lit(per)


def first_match_count(arr, word: str, label_field: str = "label",
                      count_field: str = "n") -> Column:
    """Count of the first ``(label, n)`` element whose label holds ``word``.

    "First" is in the array's stored order; callers sort the array when they
    build it, so the result does not depend on shuffle order.
    """
    return first_match(arr, word, label_field)[count_field]


def first_match(arr, word: str, label_field: str = "label") -> Column:
    """The first element whose label holds ``word``."""
    return F.get(F.filter(as_col(arr), lambda x: x[label_field].contains(word)), 0)


def housing_mix(total, single) -> dict[str, Column]:
    """multi = total - single, plus both shares of the total."""
    t, s = as_col(total), as_col(single)
    multi = t - s
    return {
        "multi": multi,
        "single_share": F.try_divide(s.cast("double"), t.cast("double")),
        "multi_share": F.try_divide(multi.cast("double"), t.cast("double")),
    }


def mode_shares(total, parts: dict[str, object]) -> dict[str, Column]:
    """Each commute mode as a share of the total (missing total -> 1)."""
    return {name: share_with_guard(c, total) for name, c in parts.items()}


def money_cents(col) -> Column:
    """A 2-decimal money value as exact integer cents."""
    return F.round(as_col(col).cast("double") * 100).cast("long")


def money_sum(col) -> Column:
    """Aggregate: exact sum of a 2-decimal money column (integer cents), as double."""
    return F.sum(money_cents(col)).cast("double") / F.lit(100.0)


def money_avg(col) -> Column:
    """Aggregate: average of a 2-decimal money column from the exact cent sum,
    so the result does not depend on the order rows are added in."""
    return F.sum(money_cents(col)).cast("double") / F.count(as_col(col)).cast("double") / F.lit(100.0)
