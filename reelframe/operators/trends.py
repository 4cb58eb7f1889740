"""A16-A19s: genre shares, yearly genre shares, yearly revenue.

Totals never go through the driver and never through an unpartitioned
window over the data:

* A16 divides by the grand total as a scalar subquery over the per-genre
  counts (one row per genre; it reuses their shuffle), then a constant in
  the projection.
* A17 divides by per-year totals joined on the year. The totals table has
  one row per year in ``[first, last]``, so its size is bounded by the
  year range itself, and it is broadcast explicitly on that proof.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json import exploded_name
from ..functions.predicates import nonzero


def _ratio(num: str, den) -> F.Column:
    return F.try_divide(F.col(num).cast("double"), den.cast("double"))


def genre_share(films: DataFrame) -> DataFrame:
    """Genre entries per genre / all genre entries. Output ``genre, ratio``."""
    counts = (films.select(exploded_name("genres", films=films).alias("genre"))
              .groupBy("genre").agg(F.count(F.lit(1)).alias("count")))
    # The total is summed from the per-genre counts, so the subquery reuses
    # the counts' shuffle instead of scanning and parsing the films again.
    total = counts.agg(F.sum("count").alias("n")).scalar()
    return counts.select("genre", _ratio("count", total).alias("ratio"))


def _genre_years(films: DataFrame, first: int | None, last: int | None) -> DataFrame:
    rows = _within(films, first, last)
    return rows.select(exploded_name("genres", films=rows).alias("genre"),
                       F.year("release_day").cast("bigint").alias("year"))


def genre_entries_by_year(films: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Genre entries per release year. Output ``year, count``."""
    return _genre_years(films, first, last).groupBy("year").agg(F.count(F.lit(1)).alias("count"))


def genre_share_by_year(films: DataFrame, first: int = 2005, last: int = 2015) -> DataFrame:
    """Per (genre, year) entry count / that year's entry count, for
    years ``first..last`` inclusive. Output ``genre, year, ratio``, ordered
    by genre, then year."""
    if last < first:
        raise ValueError("last year must not precede first year")
    counts = _genre_years(films, first, last).groupBy("genre", "year").agg(F.count(F.lit(1)).alias("count"))
    # At most last-first+1 rows: a size proven by the parameters.
    totals = counts.groupBy("year").agg(F.sum("count").alias("total"))
    return (counts.join(F.broadcast(totals), "year")
            .select("genre", "year", _ratio("count", F.col("total")).alias("ratio"))
            .orderBy("genre", "year"))


def _within(films: DataFrame, first: int | None, last: int | None) -> DataFrame:
    """Dated films of the years ``first..last``. The range is stated on the
    date column itself, so it reaches the Parquet reader as a pushed filter
    and runs before any JSON is parsed."""
    rows = films.filter(F.col("release_day").isNotNull())
    if first is not None:
        rows = rows.filter(F.col("release_day") >= F.lit(datetime.date(first, 1, 1)))
    if last is not None:
        rows = rows.filter(F.col("release_day") <= F.lit(datetime.date(last, 12, 31)))
    return rows


def _revenue_years(films: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    return (_within(films, first, last).filter(nonzero("revenue"))
            .select(F.year("release_day").cast("bigint").alias("year"), "revenue"))


def _exact_sum(column: str) -> F.Column:
    """The sum of a whole-number column; a bigint sum would overflow."""
    return F.sum(F.col(column).cast("decimal(38,0)"))


def revenue_mean_by_year(films: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Mean revenue per release year, in year order. The sum is an exact
    sum of 38 digits; the mean is that sum over the count, so it depends on
    no order of the rows."""
    return (_revenue_years(films, first, last).groupBy("year")
            .agg(_exact_sum("revenue").alias("_s"), F.count(F.lit(1)).alias("_n"))
            .select("year", _ratio("_s", F.col("_n")).alias("avg_revenue"))
            .orderBy("year"))


def revenue_total_by_year(films: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """A19s: total revenue per release year (38 digits), in year order."""
    return (_revenue_years(films, first, last).groupBy("year")
            .agg(_exact_sum("revenue").alias("total_revenue"))
            .orderBy("year"))
