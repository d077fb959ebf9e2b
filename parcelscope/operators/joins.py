"""Joins (J1-J3).

No join here carries a broadcast hint: the small sides are aggregates whose
size Spark measures itself (``autoBroadcastJoinThreshold`` on plan statistics
and, with AQE, on the actual shuffle output), so a side is broadcast only when
it really is small, and sort-merge / shuffled-hash joined otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_default(left: DataFrame, right: DataFrame, on: list[str],
                      defaults: dict[str, object]) -> DataFrame:
    """Left outer equi-join; missing right values get ``defaults``."""
    out = left.join(right, on=on, how="left")
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def lookup_update(base: DataFrame, updates: DataFrame, on: list[str], columns: list[str],
                  order_col: str | None = None) -> DataFrame:
    """Overwrite ``columns`` of ``base`` from matching ``updates`` rows.

    Matches on the *full* key (e.g. state and county), which fixes the
    reference's name-only match. When several update rows match, the one with
    the largest ``order_col`` wins ("last wins" made explicit); it is chosen by
    a keyed ``max_by`` aggregate, not by row order.
    """
    if order_col:
        picked = updates.groupBy(*on).agg(
            *[F.max_by(c, order_col).alias(f"_new_{c}") for c in columns])
    else:
        picked = updates.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns]) \
            .dropDuplicates(on)
    out = base.join(picked, on=on, how="left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.col(f"_new_{c}"), F.col(c))).drop(f"_new_{c}")
    return out


def assemble(spine: DataFrame, parts: list[DataFrame], on: list[str],
             columns: list[str] | None = None, zero_fill: bool = False) -> DataFrame:
    """One row per key of ``spine`` with the columns of every part.

    Each part must be unique per key (they are per-key aggregates); they are
    left-joined in turn, so keys missing from a part keep NULL (or 0 with
    ``zero_fill``, which reproduces the reference's table).
    """
    out = reduce(lambda acc, p: acc.join(p, on=on, how="left"), parts, spine)
    if columns:
        out = out.select(*on, *columns)
    if zero_fill:
        num = [f.name for f in out.schema.fields
               if f.name not in on and f.dataType.typeName() in ("double", "long", "integer", "float")]
        out = out.fillna(0, subset=num)
    return out
