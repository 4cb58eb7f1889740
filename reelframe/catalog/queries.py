"""Registered queries: name -> builder(spark, sf_dir) -> DataFrame.

``ANALYSES`` maps each name to a function of the typed film view;
``QUERIES`` wraps each one so it reads the whole driver tables through the
film-shaped view. Parameters are the analyses' own (top-k sizes,
thresholds, year ranges), never a way to read less data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .. import operators as op
from .. import sinks
from ..plans.config import settings
from ..plans.storage import drop_table, materialize, table_path
from ..sources import RAW_COLUMNS, RAW_SCHEMA, films_from_tables, ingest_films, load_films, read_films_csv, read_table, typed_films, write_films_csv

Builder = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
KEYWORD_K = 20          # exercises ties at the cut (64 distinct keyword names)
RUNTIME_THRESHOLD = 101  # at sf0.01 one runtime occurs exactly 101 times, so > and >= differ
SHARE_YEARS = (1996, 2000)
REVENUE_YEARS = (1900, 2100)  # the range bounds the arrays' length
CSV_FILMS = 500_000     # films in a part of csv_blocks_roundtrip, whose CSV is on disk at a time
# A query's shuffle files go when it ends, not when the driver collects garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _builder(fn: Callable[[DataFrame], DataFrame], years: tuple[int | None, int | None] = (None, None)) -> Builder:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_films(spark, sf_dir, *years))
    build.__doc__ = fn.__doc__
    return build


def _span(years: tuple[int, int]) -> int:
    return years[1] - years[0] + 1


ANALYSES: dict[str, Callable[[DataFrame], DataFrame]] = {
    # A0-A8 frequency family
    "genre_counts": op.genre_counts,
    "genre_counts_contains": op.genre_counts_contains,
    "keyword_top": lambda f: op.keyword_top(f, KEYWORD_K),
    "keyword_top_xv": lambda f: op.keyword_top(f, 100, key="x", count="value"),
    "budget_top": lambda f: op.budget_top(f, 10),
    "language_counts_contains": lambda f: op.counts_contains(f, "spoken_languages", "language"),
    "budget_ordered_rare": lambda f: op.budget_ordered(f, "count", True, 10),
    "budget_ordered": lambda f: op.budget_ordered(f, "budget", True, 10),
    "runtime_common": lambda f: op.runtime_common(f, RUNTIME_THRESHOLD, strict=True),
    "runtime_common_inclusive": lambda f: op.runtime_common(f, RUNTIME_THRESHOLD, strict=False),
    "company_top": lambda f: op.company_top(f, 10),
    "company_top_named": lambda f: op.company_top(f, 10, key="company"),
    "language_top": lambda f: op.language_top(f, 10),
    "language_top_nonblank": lambda f: op.language_top(f, 10, drop_blank=True),
    # the same by bounded summaries
    "keyword_top_heavy": lambda f: op.heavy_top(f, "keywords", KEYWORD_K, key="keyword"),
    "company_top_heavy": lambda f: op.heavy_top(f, "production_companies", 10, key="production_company"),
    "language_top_heavy": lambda f: op.heavy_top(f, "spoken_languages", 10, key="language", drop_blank=True),
    # A9-A13, A15 point tables
    "budget_vs_rating": op.budget_vs_rating,
    "budget_vs_rating_voted": op.budget_vs_rating_voted,
    "budget_vs_popularity": op.budget_vs_popularity,
    "budget_vs_votes": op.budget_vs_votes,
    "release_vs_rating": op.release_vs_rating,
    "release_vs_rating_voted": op.release_vs_rating_voted,
    "popularity_vs_rating": op.popularity_vs_rating,
    "popularity_vs_rating_voted": op.popularity_vs_rating_voted,
    "budget_vs_revenue": op.budget_vs_revenue,
    "budget_vs_revenue_any_title": lambda f: op.budget_vs_revenue(f, require_title=False),
    # A14 company ratings
    "company_rating": op.company_rating,
    "company_rating_voted": lambda f: op.company_rating(f, drop_unrated=False),
    # A16-A20 trends
    "genre_share": op.genre_share,
    "genre_share_by_year": lambda f: op.genre_share_by_year(f, *SHARE_YEARS),
    "genre_entries_by_year": op.genre_entries_by_year,
    "genre_cube": op.genre_cube,
    "revenue_mean_by_year": op.revenue_mean_by_year,
    "revenue_total_by_year": op.revenue_total_by_year,
    "genre_year_counts": op.genre_year_counts,
    # C1-C8 chart shapes
    "budget_revenue_millions": op.millions,
    "budget_rating_millions": lambda f: op.in_millions(op.budget_vs_rating(f), "budget"),
    "budget_popularity_millions": lambda f: op.in_millions(op.budget_vs_popularity(f), "budget"),
    "budget_votes_millions": lambda f: op.in_millions(op.budget_vs_votes(f), "budget"),
    "budget_top_millions": lambda f: op.in_millions(op.budget_top(f, 10), "budget"),
    "language_top_percent": lambda f: op.language_top_share(f, 10, decimals=2),
    "genre_year_matrix_cut": lambda f: op.genre_year_matrix(f, *SHARE_YEARS, decimals=3),
    "language_top_share": lambda f: op.language_top_share(f, 10),
    "runtime_labels": lambda f: op.runtime_labels(f, RUNTIME_THRESHOLD),
    "keyword_weight": lambda f: op.keyword_weight(f, 100),
    "release_date_labels": op.release_date_labels,
    "company_rating_rounded": lambda f: op.company_rating_rounded(f, 2),
    "genre_year_matrix": lambda f: op.genre_year_matrix(f, *SHARE_YEARS),
    # S3/S4 SQL text over a registered view
    "genre_counts_sql": lambda f: op.entry_counts_sql(f, "genres", "genre"),
    "runtime_common_sql": lambda f: op.runtime_common_sql(f, RUNTIME_THRESHOLD, strict=True),
    # S7-S10 result encodings
    "budget_top_document": lambda f: sinks.json_document(
        op.budget_top(f, 10), 10, order=["count", "budget"], descending=[True, False]),
    "budget_top_json_lines": lambda f: sinks.json_lines(op.budget_top(f, 10)),
    "revenue_total_arrays": lambda f: sinks.parallel_arrays(
        op.revenue_total_by_year(f, *REVENUE_YEARS), "year", "total_revenue", _span(REVENUE_YEARS)),
    "revenue_mean_arrays": lambda f: sinks.parallel_arrays(
        op.revenue_mean_by_year(f, *REVENUE_YEARS).withColumn("avg_revenue", F.round("avg_revenue", 2).cast("decimal(20,2)")),
        "year", "avg_revenue", _span(REVENUE_YEARS)),
    "genre_year_lines": lambda f: sinks.console_lines(
        op.genre_year_counts(f), "genre", "release_year", "count"),
}

# Analyses of a range of years, whose films the source view need not make for other years.
YEARS: dict[str, tuple[int, int]] = dict.fromkeys(
    ("genre_share_by_year", "genre_year_matrix", "genre_year_matrix_cut"), SHARE_YEARS)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The film rows written as CSV, read again and counted by keyword."""
    path = table_path(spark, "films-csv")
    write_films_csv(films_from_tables(spark, sf_dir, whole=True), path, compression="gzip")
    return op.entry_counts(typed_films(read_films_csv(spark, path)), "keywords", key="keyword")


def _told(films: DataFrame) -> DataFrame:
    """Film rows with an overview of three lines, quotes and commas."""
    return films.withColumn("overview", F.concat("overview", F.lit('\nsaid "'), "status", F.lit('",\n'), "id"))


def csv_blocks_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Film rows with newlines in a field written as CSV and read again by
    byte ranges, all 20 columns. The text is many times the tables, and to be
    read by ranges it is not compressed, so it is on disk in parts of about
    ``CSV_FILMS`` films: each is written, read and stored before the next."""
    films, rows = table_path(spark, "films-told"), table_path(spark, "films-read")
    parts = max(1, -(-read_table(spark, sf_dir, "orders").count() // CSV_FILMS))
    told = _told(films_from_tables(spark, sf_dir, whole=True)).select(*RAW_COLUMNS)
    part = F.pmod(F.xxhash64("id", "budget", "release_date"), F.lit(parts)).alias("part")
    with settings(spark, DROP_SHUFFLES):
        told.select("*", part).write.option("compression", "zstd").partitionBy("part").parquet(films)
        told = spark.read.schema(StructType([*RAW_SCHEMA.fields, StructField("part", LongType())])).parquet(films)
        for i in range(parts):
            path = table_path(spark, "films-csv")
            write_films_csv(told.filter(F.col("part") == i), path)
            read_films_csv(spark, path, blocks=True).write.mode("append").option("compression", "zstd").parquet(rows)
            drop_table(spark, path)
            drop_table(spark, f"{films}/part={i}")
    return spark.read.schema(RAW_SCHEMA).parquet(rows)


def csv_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The film rows written as CSV and read again line by line, all 20
    columns."""
    path = table_path(spark, "films-csv")
    write_films_csv(films_from_tables(spark, sf_dir, whole=True), path, compression="gzip")
    return read_films_csv(spark, path, multiline=False)


def json_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point table written as JSON lines and read again."""
    path, points = table_path(spark, "points-json"), op.budget_vs_rating_voted(load_films(spark, sf_dir))
    sinks.write_json(points, path)
    return spark.read.schema(points.schema).json(path)


def json_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point table of any size written as one JSON array of points, and
    its elements read again from the array's lines."""
    path, points = table_path(spark, "points-array"), op.budget_vs_rating_voted(load_films(spark, sf_dir))
    sinks.write_json_array(points, path, order=("title", "budget"), points=True)
    lines = spark.read.text(sinks.current(spark, path)).filter("value not in (']', '[]')")
    values = F.from_json(F.substring("value", 2, 1 << 30), "array<string>")
    names = zip(points.columns, points.dtypes)
    return lines.select(values.alias("v")).select(*[F.col("v")[k].cast(kind).alias(name) for k, (name, (_, kind)) in enumerate(names)])


def _elements(spark: SparkSession, written: dict[str, str]) -> DataFrame:
    """``(job, elements)`` of written export files."""
    counts = []
    for name, path in sorted(written.items()):
        # A bounded job's file is one line; the others have an element per line.
        lines = spark.read.text(sinks.current(spark, path))
        if sinks.DEFAULT_JOBS[name].bound is not None:
            n = F.sum(F.json_array_length("value"))
        else:
            n = F.count(F.when(~F.col("value").isin("]", "[]"), 1))
        counts.append(lines.agg(F.lit(name).alias("job"), n.cast("bigint").alias("elements")))
    return reduce(DataFrame.unionByName, counts)


def export_jobs_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All export jobs written and read again: the number of elements of
    each file."""
    base = table_path(spark, "exports")
    films = materialize(load_films(spark, sf_dir), "films")
    written = sinks.run_jobs(films, base, parallelism=4)
    return _elements(spark, written)


def clustered_share_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The films stored in files of release days, and the genre
    shares of a range of years read from the files that have them."""
    films = ingest_films(films_from_tables(spark, sf_dir, whole=True), "films-by-date", by_date=32)
    return op.genre_share_by_year(films, *SHARE_YEARS)


def genre_results_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A16, A17 and A18 read from one stored cube, one scan of the films."""
    cube = materialize(op.genre_cube(load_films(spark, sf_dir)), "genre-cube")
    results = {"counts": (op.cube_counts(cube), "count"), "share": (op.cube_share(cube), "ratio"),
               "entries_by_year": (op.cube_entries_by_year(cube), "count"),
               "share_by_year": (op.cube_share_by_year(cube, *SHARE_YEARS), "ratio")}
    rows = [df.select(F.lit(name).alias("result"),
                      *[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in (("genre", "string"), ("year", "bigint"))],
                      F.col(value).cast("double").alias("value")) for name, (df, value) in results.items()]
    return reduce(DataFrame.unionByName, rows)


def export_jobs_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export whose last two jobs are still to run, started again under
    its name: each job, whether the second start ran it, and its file's elements."""
    base, films = table_path(spark, "exports"), materialize(load_films(spark, sf_dir), "films")
    before = {name: job for name, job in sinks.DEFAULT_JOBS.items() if name not in ("movies_vote", "budget_revenue")}
    sinks.run_jobs(films, base, before, run="export", parallelism=4)
    done = sinks.finished_jobs(spark, base, "export")
    written = sinks.run_jobs(films, base, run="export", parallelism=4)
    return _elements(spark, written).withColumn("second", ~F.col("job").isin(*done))


QUERIES: dict[str, Builder] = {
    **{name: _builder(fn, YEARS.get(name, (None, None))) for name, fn in ANALYSES.items()},
    "csv_roundtrip": csv_roundtrip,
    "csv_blocks_roundtrip": csv_blocks_roundtrip,
    "csv_lines_roundtrip": csv_lines_roundtrip,
    "json_sink_roundtrip": json_sink_roundtrip,
    "json_array_roundtrip": json_array_roundtrip,
    "export_jobs_roundtrip": export_jobs_roundtrip,
    "clustered_share_by_year": clustered_share_by_year,
    "genre_results_one_pass": genre_results_one_pass,
    "export_jobs_resumed": export_jobs_resumed,
}
