"""Invariants of the analyses on the sf0.001 tables."""

from __future__ import annotations

from collections import defaultdict

import pytest

from conftest import SF_SMALL
from reelframe import operators as op
from reelframe.sources import load_films


@pytest.fixture(scope="module")
def films(spark):
    return load_films(spark, SF_SMALL).cache()


def test_year_shares_sum_to_one(films):
    sums = defaultdict(float)
    for r in op.genre_share_by_year(films, 1995, 2001).collect():
        sums[r.year] += r.ratio
    assert sums and all(abs(v - 1.0) < 1e-12 for v in sums.values())


def test_overall_shares_sum_to_one(films):
    assert abs(sum(r.ratio for r in op.genre_share(films).collect()) - 1.0) < 1e-12


def test_top_k_is_prefix_of_full_ranking(films):
    full = [tuple(r) for r in op.keyword_top(films, 10_000).collect()]
    for k in (1, 5, 20):
        assert [tuple(r) for r in op.keyword_top(films, k).collect()] == full[:k]


def test_contains_equals_exact_names_when_no_name_contains_another(films):
    names = [r.genre for r in op.genre_counts(films).collect()]
    assert not any(a != b and a in b for a in names for b in names)
    exact = {r.genre: r["count"] for r in op.genre_counts(films).collect()}
    contained = {r.genre: r["count"] for r in op.genre_counts_contains(films).collect()}
    assert exact == contained


def test_company_counts_sum_to_filtered_entries(films):
    from pyspark.sql import functions as F
    from reelframe.functions import exploded_name
    total = sum(r["count"] for r in op.company_rating(films).collect())
    entries = (films.filter((F.col("vote_count") > 100) & (F.col("vote_average") != 0))
               .select(exploded_name("production_companies")).count())
    assert total == entries


def test_year_entries_sum_to_dated_entries(films):
    from pyspark.sql import functions as F
    per_year = sum(r["count"] for r in op.genre_entries_by_year(films).collect())
    dated = op.entry_counts(films.filter(F.col("release_day").isNotNull()), "genres")
    assert per_year == sum(r["count"] for r in dated.collect())


def test_revenue_mean_times_count_is_total(films):
    from pyspark.sql import functions as F
    means = {r.year: r.avg_revenue for r in op.revenue_mean_by_year(films).collect()}
    totals = {r.year: r.total_revenue for r in op.revenue_total_by_year(films).collect()}
    n = {r.year: r.n for r in films.filter((F.col("revenue") != 0) & F.col("release_day").isNotNull())
         .groupBy(F.year("release_day").cast("bigint").alias("year")).agg(F.count("*").alias("n")).collect()}
    assert means.keys() == totals.keys() == n.keys()
    for y in means:
        assert means[y] * n[y] == pytest.approx(totals[y])
