"""Column helpers for the JSON-in-text list columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schema import JSON_COLUMNS, NAME_SCHEMA, NAMES_SUFFIX


def parsed_entries(column: str, schema: str | None = None) -> Column:
    """Array of structs parsed from the JSON text; null when it does not parse."""
    return F.from_json(F.col(column), schema or JSON_COLUMNS.get(column, NAME_SCHEMA))


def entry_names(column: str, schema: str | None = None) -> Column:
    """Array of the ``name`` field of every entry. Only ``name`` is read, so
    Catalyst prunes the parse schema to that one field."""
    return parsed_entries(column, schema).getField("name")


def names_of(films: DataFrame, column: str) -> Column:
    """The entry names of ``column``: the stored ``<column>_names`` array when
    the table was ingested with parsed lists, else parsed from the JSON text.
    Both give the same array, so operators accept either form."""
    stored = column + NAMES_SUFFIX
    return F.col(stored) if stored in films.columns else entry_names(column)


def exploded_name(column: str, schema: str | None = None, films: DataFrame | None = None) -> Column:
    """One row per entry (generator column); null or unparseable text yields no row."""
    if films is not None and schema is None:
        return F.explode(names_of(films, column))
    return F.explode(entry_names(column, schema))
