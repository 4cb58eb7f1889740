"""One pass for the genre results: A1, A16, A17 and A18 from grouping sets.

The films are scanned, and their genres counted per (genre, year), once.
The grouping sets (genre), (year), (genre, year) and () are taken over those
counts, some thousand rows, not over the entries, so no entry is expanded
into four. The results are selections of the one small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json import exploded_name
from .trends import _ratio

# Values of ``level``: a bit is set where the column is summed over.
GENRE_YEAR, GENRE, YEAR, ALL = 0, 1, 2, 3


def genre_cube(films: DataFrame) -> DataFrame:
    """``(level, genre, year, count)``: genre entries by genre and release
    year at all four levels. Entries of undated films have a null year, at
    the levels that keep it; ``level`` tells it from a sum over years."""
    entries = films.select(exploded_name("genres", films=films).alias("genre"), F.year("release_day").cast("bigint").alias("year"))
    counts = entries.groupBy("genre", "year").agg(F.count(F.lit(1)).alias("n"))
    genre, year = F.col("genre"), F.col("year")
    sets = counts.groupingSets([[genre, year], [genre], [year], []], genre, year)
    return sets.agg(F.grouping_id().cast("int").alias("level"), F.sum("n").alias("count")).select("level", "genre", "year", "count")


def cube_counts(cube: DataFrame) -> DataFrame:
    """A1 from the cube: ``genre, count``."""
    return cube.filter(F.col("level") == GENRE).select("genre", "count")


def cube_share(cube: DataFrame) -> DataFrame:
    """A16 from the cube: ``genre, ratio``."""
    total = cube.filter(F.col("level") == ALL).agg(F.max("count").alias("n")).scalar()
    return cube_counts(cube).select("genre", _ratio("count", total).alias("ratio"))


def cube_entries_by_year(cube: DataFrame) -> DataFrame:
    """A18 from the cube: ``year, count``."""
    return cube.filter((F.col("level") == YEAR) & F.col("year").isNotNull()).select("year", "count")


def cube_share_by_year(cube: DataFrame, first: int, last: int) -> DataFrame:
    """A17 from the cube: ``genre, year, ratio`` of the years ``first..last``."""
    inside = cube.filter(F.col("year").between(first, last))
    totals = inside.filter(F.col("level") == YEAR).select("year", F.col("count").alias("total"))
    # At most last-first+1 rows.
    rows = inside.filter(F.col("level") == GENRE_YEAR).join(F.broadcast(totals), "year")
    return rows.select("genre", "year", _ratio("count", F.col("total")).alias("ratio")).orderBy("genre", "year")
