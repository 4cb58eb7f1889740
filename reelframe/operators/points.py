"""Per-film point tables relating two measures.

Pure filter + projection: no shuffle. Filters are plain Column predicates
on the typed view, so Catalyst evaluates them in the scan's stage (and
pushes them into the Parquet reader when the view's columns come straight
from a file); only the projected columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import above, all_of, nonzero, not_blank


def _points(films: DataFrame, keep, *cols) -> DataFrame:
    return films.filter(keep).select(*cols)


def budget_vs_rating(films: DataFrame) -> DataFrame:
    """Titled films with a non-zero rating and budget."""
    return _points(films, all_of(not_blank("title"), nonzero("vote_average"), nonzero("budget")),
                   "title", "budget", "vote_average")


def budget_vs_rating_voted(films: DataFrame, min_votes: int = 100) -> DataFrame:
    """A9p: non-zero budget and more than ``min_votes`` votes (no title or rating test)."""
    return _points(films, all_of(nonzero("budget"), above("vote_count", min_votes)),
                   "title", "budget", "vote_average")


def budget_vs_popularity(films: DataFrame) -> DataFrame:
    """A10."""
    return _points(films, all_of(not_blank("title"), nonzero("popularity"), nonzero("budget")),
                   "title", "budget", "popularity")


def budget_vs_votes(films: DataFrame) -> DataFrame:
    """A11."""
    return _points(films, all_of(not_blank("title"), nonzero("vote_count"), nonzero("budget")),
                   "title", "budget", "vote_count")


def release_vs_rating(films: DataFrame, *extra) -> DataFrame:
    """Release-date text is emitted as ``release``; ``extra`` columns
    are appended (shapes use it to label the points)."""
    return _points(films, all_of(not_blank("title"), nonzero("vote_average")),
                   "title", F.col("release_date").alias("release"), "vote_average", *extra)


def release_vs_rating_voted(films: DataFrame, min_votes: int = 100) -> DataFrame:
    """A12p: a release date and more than ``min_votes`` votes."""
    return _points(films, all_of(not_blank("release_date"), above("vote_count", min_votes)),
                   "release_date", "vote_average", "title")


def popularity_vs_rating(films: DataFrame) -> DataFrame:
    """A13 (popularity stays numeric)."""
    return _points(films, all_of(not_blank("title"), nonzero("vote_average")),
                   "title", "popularity", "vote_average")


def popularity_vs_rating_voted(films: DataFrame, min_votes: int = 100) -> DataFrame:
    """A13p."""
    return _points(films, all_of(nonzero("popularity"), above("vote_count", min_votes)),
                   "title", "popularity", "vote_average")


def budget_vs_revenue(films: DataFrame, *, require_title: bool = True) -> DataFrame:
    """A15 (``require_title=False`` is A15p)."""
    keep = all_of(nonzero("budget"), nonzero("revenue"))
    if require_title:
        keep = not_blank("title") & keep
    return _points(films, keep, "title", "budget", "revenue")
