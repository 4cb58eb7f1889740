"""Row predicates over the typed view. A null operand makes the predicate
null, which drops the row (SQL semantics for missing values)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonzero(column: str) -> Column:
    return F.col(column) != 0


def not_blank(column: str) -> Column:
    return F.col(column) != ""


def above(column: str, threshold: float, *, strict: bool = True) -> Column:
    c = F.col(column)
    return c > threshold if strict else c >= threshold


def all_of(*preds: Column) -> Column:
    return reduce(lambda a, b: a & b, preds)
