"""The reshaping the chart pages apply to analysis results, as columns.

Shares and min-max weights are computed over the listed rows only, with
their total or range as a scalar subquery over the same ranking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import suffixed, unpadded_date
from .frequency import keyword_top, language_top, runtime_common
from .points import budget_vs_revenue, release_vs_rating
from .ratings import company_rating
from .trends import genre_share_by_year


def in_millions(points: DataFrame, *columns: str) -> DataFrame:
    """``points`` with each of ``columns`` as ``<column>_millions``."""
    return points.select(*[(F.col(c) / F.lit(1e6)).alias(f"{c}_millions") if c in columns else F.col(c) for c in points.columns])


def millions(films: DataFrame) -> DataFrame:
    """C1 over A15: budget vs. revenue points, both money columns in millions."""
    return in_millions(budget_vs_revenue(films), "budget", "revenue")


def top_share(top: DataFrame, count: str = "count", *, decimals: int | None = None) -> DataFrame:
    """Each listed row's share of the listed total, and with ``decimals``
    its percentage rounded to so many places. The total is a scalar
    subquery, so ``top`` may have any size."""
    total = top.agg(F.sum(count).alias("n")).scalar().cast("double")
    out = top.withColumn("share", F.try_divide(F.col(count).cast("double"), total))
    if decimals is not None:
        out = out.withColumn("percent", F.round(F.col("share") * 100, decimals))
    return out


def language_top_share(films: DataFrame, k: int = 10, *, drop_blank: bool = False,
                       decimals: int | None = None) -> DataFrame:
    """C2 over A8 (blank names kept, as in the ranking the chart reads):
    language, count, share of the top-k total."""
    return top_share(language_top(films, k, drop_blank=drop_blank), decimals=decimals)


def runtime_labels(films: DataFrame, threshold: int = 100, *, strict: bool = True) -> DataFrame:
    """A6 with a ``"<runtime> min."`` label."""
    rc = runtime_common(films, threshold, strict=strict)
    return rc.withColumn("label", suffixed(F.col("runtime"), " min."))


def scaled(top: DataFrame, count: str = "count", lo: float = 24.0, hi: float = 40.0) -> DataFrame:
    """C4: min-max scale ``count`` over the listed rows to ``[lo, hi]``;
    null when every listed count is equal. The range is two scalar
    subqueries, so ``top`` may have any size."""
    mn = top.agg(F.min(count).alias("n")).scalar()
    mx = top.agg(F.max(count).alias("n")).scalar()
    frac = F.try_divide((F.col(count) - mn).cast("double"), (mx - mn).cast("double"))
    return top.withColumn("weight", frac * F.lit(hi - lo) + F.lit(lo))


def keyword_weight(films: DataFrame, k: int = 100, lo: float = 24.0, hi: float = 40.0) -> DataFrame:
    """C4 over A3: keyword, count, weight."""
    return scaled(keyword_top(films, k), "count", lo, hi)


def release_date_labels(films: DataFrame) -> DataFrame:
    """A12 with an unpadded ``Y-M-D`` label of the parsed date."""
    return release_vs_rating(films, unpadded_date(F.col("release_day")).alias("label"))


def company_rating_rounded(films: DataFrame, decimals: int = 2, min_votes: int = 100) -> DataFrame:
    """A14 with the mean rounded."""
    cr = company_rating(films, min_votes)
    return cr.select("company", F.round("average", decimals).alias("average"), "count")


def genre_year_matrix(films: DataFrame, first: int, last: int, *, decimals: int | None = None) -> DataFrame:
    """One row per genre, one column per year ``first..last`` holding
    A17's share, cut (not rounded) to ``decimals`` places if given; a
    missing cell is 0. The pivot values are the explicit year list, so no
    extra job runs to discover them."""
    years = list(range(first, last + 1))
    shares = genre_share_by_year(films, first, last)
    step = 10 ** decimals if decimals is not None else 1
    value = F.floor(F.col("ratio") * step) / F.lit(float(step)) if decimals is not None else F.col("ratio")
    grid = (shares.select("genre", "year", value.alias("ratio"))
            .groupBy("genre").pivot("year", years).agg(F.max("ratio")))
    return grid.na.fill(0.0, [str(y) for y in years])
