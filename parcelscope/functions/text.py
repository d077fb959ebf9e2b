"""Column expressions over raw text lines and labels.

All builders return ``Column`` objects made of built-in Spark functions, so
they stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelscope.functions._util import as_col

# Fixed value: a comma counts as a separator only when an even number of
# double quotes follows it up to the end of the line (i.e. it is outside any
# quoted field). Same rule the reference programs split with.
QUOTE_AWARE_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def split_pick(col, k: int, sep: str = ",") -> Column:
    """Plain split on a literal separator, field ``k`` (0-based).

    Quotes are not honoured: ``"Adams County, Ohio"`` becomes two fields,
    exactly as a naive split does. Missing positions give NULL.
    """
    return F.get(F.split(as_col(col), _regex_escape(sep), -1), k)


def split_quoted(col, keep_trailing_empty: bool = True) -> Column:
    """Split on commas outside double quotes; returns ``array<string>``.

    ``keep_trailing_empty=False`` reproduces Java's ``split(regex, 0)``:
    trailing empty fields are removed.
    """
    c = as_col(col)
    if not keep_trailing_empty:
        c = F.regexp_replace(c, ",+$", "")
    return F.split(c, QUOTE_AWARE_COMMA, -1)


def csv_fields(col, n_fields: int) -> Column:
    """P2, linear-time variant: parse one CSV line into ``_c0 .. _c{n-1}``.

    Uses Spark's CSV parser (``from_csv``), which honours quotes and escapes
    in one pass, instead of a look-ahead regex that rescans the rest of the
    line at each comma.
    """
    schema = ", ".join(f"_c{i} STRING" for i in range(n_fields))
    return F.from_csv(as_col(col), schema)


def pick(col, k: int) -> Column:
    """Positional field ``k`` of an array or of a ``_c*`` struct."""
    return F.get(as_col(col), k)


def null_label(col, text: str = "null") -> Column:
    """A NULL label becomes the literal text ``null``."""
    return F.coalesce(as_col(col), F.lit(text))


def lower_label(col) -> Column:
    """P5."""
    return F.lower(as_col(col))


def strip_quotes(col) -> Column:
    """Delete every double-quote character."""
    return F.translate(as_col(col), '"', "")


def strip_suffix(col, suffix: str = " County", lower: bool = True) -> Column:
    """Remove a trailing suffix (literal), then optionally lower-case."""
    pattern = _regex_escape(suffix) + "$"
    c = F.regexp_replace(as_col(col), pattern, "")
    return F.lower(c) if lower else c


def clean_key(col, prefix_len: int = 2, suffix: str = " county") -> tuple[Column, Column]:
    """Split a ``<state><County Name> County`` key into (state, county).

    Returns the state prefix as written and the lower-cased county name with
    every occurrence of ``suffix`` removed.
    """
    c = strip_quotes(col)
    state = F.substring(c, 1, prefix_len)
    rest = F.substr(c, F.lit(prefix_len + 1))
    county = F.replace(F.lower(rest), F.lit(suffix), F.lit(""))
    return state, county


def render_pairs(pairs: list[tuple[str, Column]], sep: str = "") -> Column:
    """Render ``name:value`` pairs into one text (the reference's result line)."""
    parts = []
    for name, c in pairs:
        parts.append(F.concat(F.lit(f"{name}:"), F.coalesce(c.cast("string"), F.lit("null"))))
    return F.concat_ws(sep, *parts)


def _regex_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch)
    return "".join(out)
