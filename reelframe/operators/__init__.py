"""Analyses: lazy ``DataFrame -> DataFrame`` functions over the typed film view."""

from .containment import (containment_counts, counts_contains, distinct_names, genre_counts_contains,
                          genre_year_counts)
from .cube import cube_counts, cube_entries_by_year, cube_share, cube_share_by_year, genre_cube
from .frequency import (budget_ordered, budget_top, company_top, entry_counts, genre_counts,
                        keyword_top, language_top, ranked, runtime_common, top_k, value_counts)
from .heavy import heavy_names, heavy_top
from .points import (budget_vs_popularity, budget_vs_rating, budget_vs_rating_voted,
                     budget_vs_revenue, budget_vs_votes, popularity_vs_rating,
                     popularity_vs_rating_voted, release_vs_rating, release_vs_rating_voted)
from .ratings import company_rating
from .shapes import (company_rating_rounded, genre_year_matrix, keyword_weight,
                     in_millions, language_top_share, millions, release_date_labels, runtime_labels,
                     scaled, top_share)
from .sql import entry_counts_sql, register, runtime_common_sql
from .trends import (genre_entries_by_year, genre_share, genre_share_by_year,
                     revenue_mean_by_year, revenue_total_by_year)

__all__ = [
    "budget_ordered", "budget_top", "entry_counts_sql", "register", "runtime_common_sql", "budget_vs_popularity", "budget_vs_rating",
    "budget_vs_rating_voted", "budget_vs_revenue", "budget_vs_votes", "company_rating",
    "company_rating_rounded", "company_top", "containment_counts", "counts_contains", "distinct_names",
    "entry_counts", "genre_counts", "genre_counts_contains", "genre_entries_by_year",
    "genre_share", "genre_share_by_year", "genre_year_counts", "genre_year_matrix", "in_millions",
    "keyword_top", "keyword_weight", "language_top", "language_top_share", "millions",
    "popularity_vs_rating", "popularity_vs_rating_voted", "ranked", "release_date_labels",
    "release_vs_rating", "release_vs_rating_voted", "revenue_mean_by_year",
    "revenue_total_by_year", "runtime_common", "runtime_labels", "scaled", "top_k",
    "top_share", "value_counts", "cube_counts", "cube_entries_by_year", "cube_share", "cube_share_by_year",
    "genre_cube", "heavy_names", "heavy_top",
]
