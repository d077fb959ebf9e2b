"""Row filters (F1-F6) as predicates built from configuration.

Every predicate is a Column, so Catalyst pushes what it can into the scan:
``startswith`` / ``isin`` / comparisons become Parquet filters, ``contains``
is evaluated right after the scan, before any shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelscope.functions._util import as_col


def keyword_any(col, words) -> Column:
    """true when the text holds any of ``words`` as a substring.

    Pure substring, as in the reference: ``house`` also matches
    ``warehouse``. An empty list matches nothing.
    """
    c = as_col(col)
    words = list(words)
    if not words:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def prefix(col, p: str) -> Column:
    """text starts with ``p``."""
    return as_col(col).startswith(p)


def prefix_any(col, prefixes) -> Column:
    """text starts with any of ``prefixes``.

    An OR of ``startswith``: on a Parquet column Spark pushes it into the
    scan (``Or(StringStartsWith, ...)``), where a ``substring(...) IN`` test
    would not be.
    """
    c = as_col(col)
    prefixes = list(prefixes)
    if not prefixes:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in prefixes])


def key_in_set(col, keys) -> Column:
    """F4."""
    return as_col(col).isin(*list(keys))


def threshold(col, op: str, value) -> Column:
    """numeric comparison ``col <op> value``."""
    c = as_col(col)
    ops = {
        ">": c > value, ">=": c >= value, "<": c < value, "<=": c <= value,
        "==": c == value, "!=": c != value,
    }
    return ops[op]


def nonzero(col) -> Column:
    """value present and not 0."""
    c = as_col(col)
    return c.isNotNull() & (c != 0)
