"""Entry frequencies, value frequencies, having thresholds, top-k.

Every count is a ``groupBy().agg(count)``: Spark plans a partial hash
aggregate before the shuffle, so a dominant key (one genre holding a third
of all entries) is pre-combined per task and reaches the final aggregate as
one row per task, not as its raw rows. Rankings are ``orderBy().limit(k)``,
which plans ``TakeOrderedAndProject``: each task keeps its local top k and
only k rows per task move. Ties are broken on the key, ascending, so the
top k is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import exploded_name
from ..functions.predicates import above, nonzero


def entry_counts(films: DataFrame, column: str, *, key: str = "name", count: str = "count",
                 drop_blank: bool = False) -> DataFrame:
    """A0: occurrences of each entry name in a JSON list column.

    Counts entries, not films: a name listed twice in one film counts twice.
    Null and unparseable text contribute nothing.
    """
    names = films.select(exploded_name(column, films=films).alias(key))
    if drop_blank:
        names = names.filter(F.col(key) != "")
    return names.groupBy(key).agg(F.count(F.lit(1)).alias(count))


def value_counts(films: DataFrame, column: str, *, count: str = "count",
                 drop_zero: bool = True) -> DataFrame:
    """Films per distinct value of a typed column, zero (and null) dropped."""
    rows = films.select(column)
    rows = rows.filter(nonzero(column)) if drop_zero else rows.filter(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias(count))


def ranked(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows under ``order`` (plans as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def top_k(counts: DataFrame, k: int, key: str, count: str = "count") -> DataFrame:
    return ranked(counts, k, F.col(count).desc(), F.col(key).asc())


def genre_counts(films: DataFrame) -> DataFrame:
    """A1: genre entries per genre name. Output ``genre, count``."""
    return entry_counts(films, "genres", key="genre")


def keyword_top(films: DataFrame, k: int = 100, *, key: str = "keyword", count: str = "count") -> DataFrame:
    """A3 (``key='x', count='value'`` gives the A3p field names)."""
    return top_k(entry_counts(films, "keywords", key=key, count=count), k, key, count)


def budget_top(films: DataFrame, k: int = 10) -> DataFrame:
    """A5: most common non-zero budgets."""
    return top_k(value_counts(films, "budget"), k, "budget")


def budget_ordered(films: DataFrame, order: str = "count", ascending: bool = False,
                   k: int = 10) -> DataFrame:
    """A5p: budget counts ordered by a caller-chosen column and direction, first ``k``.

    Budgets are ordered numerically (typed view), not as text.
    """
    if order not in ("budget", "count"):
        raise ValueError(f"order must be 'budget' or 'count', not {order!r}")
    first = F.col(order).asc() if ascending else F.col(order).desc()
    tie = F.col("budget").asc()
    return ranked(value_counts(films, "budget"), k, first, tie)


def runtime_common(films: DataFrame, threshold: int = 100, *, strict: bool = True) -> DataFrame:
    """A6 (``strict=True``, count > t) and A6p (``strict=False``, count >= t).

    Runtime zero is dropped (the documented intent), counts are filtered after
    the aggregate (having), most common first.
    """
    counts = value_counts(films, "runtime").filter(above("count", threshold, strict=strict))
    return counts.orderBy(F.col("count").desc(), F.col("runtime").asc())


def company_top(films: DataFrame, k: int = 10, *, key: str = "production_company") -> DataFrame:
    """A7 (``key='company'`` gives the A7p field name)."""
    return top_k(entry_counts(films, "production_companies", key=key), k, key)


def language_top(films: DataFrame, k: int = 10, *, drop_blank: bool = False) -> DataFrame:
    """A8 keeps blank language names; A8p (``drop_blank=True``) drops them before ranking."""
    return top_k(entry_counts(films, "spoken_languages", key="language", drop_blank=drop_blank),
                 k, "language")
