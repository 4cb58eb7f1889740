"""Analyses written as SQL text over a registered view.

The film view is registered with ``createOrReplaceTempView`` and queried
with ``spark.sql(text, args=...)``: parameters are bound as literals by the
parser (named parameter markers), never pasted into the text, so a name or
threshold cannot change the statement. Catalyst plans SQL text and the
DataFrame forms identically.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from ..sources.schema import ENTRY_SCHEMA, NAMES_SUFFIX

VIEW = "films"


def register(films: DataFrame, name: str = VIEW) -> str:
    """S3: register ``films`` as a temporary view; returns the view name."""
    films.createOrReplaceTempView(name)
    return name


@contextmanager
def _view(films: DataFrame, name: str | None) -> Iterator[str]:
    """The view ``name``, which stays; without a name one of its own, dropped
    when the statement has been analysed, so no other view is replaced."""
    view = register(films, name or f"{VIEW}_{uuid.uuid4().hex}")
    try:
        yield view
    finally:
        if name is None:
            films.sparkSession.catalog.dropTempView(view)


def runtime_common_sql(films: DataFrame, threshold: int = 100, *, strict: bool = True,
                       view: str | None = None) -> DataFrame:
    """A6/A6p as SQL text with a bound threshold."""
    spark = films.sparkSession
    having = "count(*) > :threshold" if strict else "count(*) >= :threshold"
    with _view(films, view) as name:
        return spark.sql(
            f"SELECT runtime, count(*) AS count FROM {name} WHERE runtime <> 0 "
            f"GROUP BY runtime HAVING {having} ORDER BY count DESC, runtime",
            args={"threshold": threshold})


def entry_counts_sql(films: DataFrame, column: str = "genres", key: str = "genre",
                     view: str | None = None) -> DataFrame:
    """A0/A1 as SQL text: explode the parsed entries with a lateral view and
    count per name. The parse schema is a bound parameter."""
    spark = films.sparkSession
    if not column.isidentifier() or not key.isidentifier():
        raise ValueError("column and key must be plain identifiers")
    stored = column + NAMES_SUFFIX
    with _view(films, view) as source:
        if stored in films.columns:  # names parsed once at ingest
            return spark.sql(
                f"SELECT name AS {key}, count(*) AS count "
                f"FROM {source} LATERAL VIEW explode({stored}) t AS name GROUP BY name")
        return spark.sql(
            f"SELECT e.name AS {key}, count(*) AS count "
            f"FROM {source} LATERAL VIEW explode(from_json({column}, :schema)) t AS e "
            f"GROUP BY e.name",
            args={"schema": ENTRY_SCHEMA})
