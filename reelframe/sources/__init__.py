"""Sources: the raw film schema, the CSV reader, the typed view and the
film-shaped view over the driver's tables."""

from .csv import ingest_csv, malformed_records, read_films_csv, write_films_csv
from .schema import JSON_COLUMNS, NAMES_SUFFIX, RAW_COLUMNS, RAW_SCHEMA
from .testdata import films_from_tables, read_table
from .typed import rejected_rows, rejected_values, typed_films


def load_films(spark, sf_dir: str, first: int | None = None, last: int | None = None):
    """Typed film view over the tables in ``sf_dir`` (computed, not stored),
    of all films or of those released in the years ``first..last``."""
    return typed_films(films_from_tables(spark, sf_dir, first, last))


def ingest_films(raw, name: str = "films", *, parse_lists: bool = True, partitions: int | None = None,
                 path: str | None = None, by_date: int | None = None):
    """Type the raw film rows once and store them as Parquet in the shared
    checkpoint folder (or at ``path``); return the stored table.

    Stored numbers and dates are typed, so analysis predicates such as
    ``budget <> 0`` reach the Parquet reader (row-group skipping) and each
    analysis reads only its columns. With ``parse_lists`` each JSON list
    column also gets a ``<column>_names`` array, parsed here once instead of
    in every analysis (the JSON text is kept for containment and the
    rejected-row report). Rows are sorted by release day within each task
    (no shuffle), which keeps the day statistics of each row group narrow.

    ``partitions`` spreads the rows evenly over that many tasks before the
    per-row work: a multi-line CSV is read one task per file, so a source
    made of a few very large files would otherwise type, parse and write in
    a few tasks. (Spark sorts locally before a round-robin repartition, so a
    retried task produces the same rows.)

    ``by_date`` clusters the stored table: the rows are range-partitioned by
    release day into about that many files, one shuffle at ingest, so a
    range of years skips the files of other years by their footers. They are
    stored unclustered first, as the ranges' sample is a job of its own that
    would compute ``raw`` once more; that table is dropped at the end. Days are
    cut further by film id, so a day (or null) that very many films share
    spans several files.
    """
    from pyspark.sql import functions as F

    from ..functions.json import entry_names
    from ..plans.storage import drop_table, materialize, table_path
    films = typed_films(raw.repartition(partitions) if partitions else raw)
    lists = [entry_names(c).alias(c + NAMES_SUFFIX) for c in JSON_COLUMNS if parse_lists and c in films.columns]
    if not by_date:
        return materialize(films.select("*", *lists).sortWithinPartitions(F.col("release_day")), name, path=path)
    spark, folder = films.sparkSession, table_path(films.sparkSession, f"{name}-unclustered")
    try:
        films = materialize(films, name, path=folder).repartitionByRange(by_date, F.col("release_day"), F.xxhash64("id"))
        # The lists are parsed where they are written, so the shuffle has their text alone.
        return materialize(films.select("*", *lists).sortWithinPartitions(F.col("release_day")), name, path=path)
    finally:
        drop_table(spark, folder)


__all__ = [
    "JSON_COLUMNS", "RAW_COLUMNS", "RAW_SCHEMA", "films_from_tables", "ingest_csv", "ingest_films",
    "load_films", "malformed_records", "read_films_csv", "read_table", "rejected_rows", "rejected_values",
    "typed_films", "write_films_csv",
]
