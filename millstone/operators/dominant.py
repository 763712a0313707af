"""Dominant category (mode) over a CLOSED set of categories.

Instead of ``count per category -> row_number by count`` (two extra scans
and two joins), the counts are conditional aggregates of the same single
``groupBy`` and the winner is an arg-max over those columns with a fixed
tie order.  One scan, one exchange, map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millstone.functions.classify import top_of


def category_counts(col: str, categories: list[str], prefix: str, weight: Column | None = None) -> list[Column]:
    """``count_if(col = c)`` per category (or ``sum(weight)`` when given)."""
    out = []
    for c in categories:
        cond = F.col(col) == c
        e = F.count_if(cond) if weight is None else F.sum(F.when(cond, weight).otherwise(0))
        out.append(e.cast("long").alias(f"{prefix}{c.lower()}"))
    return out


def dominant(categories_in_tie_order: list[str], prefix: str) -> Column:
    """Arg-max of the ``prefix<cat>`` count columns; the first category in
    the given order wins ties; NULL when all counts are 0."""
    return top_of({c: F.col(f"{prefix}{c.lower()}") for c in categories_in_tie_order})
