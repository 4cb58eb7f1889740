"""Typed view over the raw text columns.

Spark 4 runs with ANSI mode on, so comparing dirty text with a number or
parsing a bad date raises. All conversion happens here, once, with the
``try_*`` forms: text that is not a number or a date becomes null, and
empty text becomes null; ``10.0`` is the whole number 10, ``2009-1-5`` and
``2009`` are dates. Analyses only ever see typed columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .schema import BIGINT_COLUMNS, DOUBLE_COLUMNS, JSON_COLUMNS


def _blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def typed_films(raw: DataFrame) -> DataFrame:
    """Same columns as ``raw`` with numbers typed, plus ``release_day`` (date).

    ``release_date`` stays text (A12 and A20 use the text form).
    """
    text = {f.name for f in raw.schema.fields if isinstance(f.dataType, StringType)}
    cols = []
    for name in raw.columns:
        if name not in text:  # already typed: pass through (the view is idempotent)
            cols.append(F.col(name))
            continue
        c = _blank_to_null(F.col(name))
        if name in BIGINT_COLUMNS:
            c = c.try_cast("decimal(38,6)").try_cast("bigint")
        elif name in DOUBLE_COLUMNS:
            c = c.try_cast("double")
        cols.append(c.alias(name))
    if "release_date" in raw.columns and "release_day" not in raw.columns:
        cols.append(_blank_to_null(F.col("release_date")).try_cast("date").alias("release_day"))
    return raw.select(*cols)


def rejected_rows(films: DataFrame, column: str = "genres") -> DataFrame:
    """Rows whose JSON column holds text that does not parse (Q20).

    ``from_json`` turns such text into null and ``explode`` then drops the
    row, so analyses never fail on it; this reports what was dropped, using
    the same parse the analyses use.
    """
    from ..functions.json import entry_names
    return films.filter(F.col(column).isNotNull() & entry_names(column).isNull()).select("id", "title", column)


def rejected_values(raw: DataFrame) -> DataFrame:
    """``(id, title, column, value)`` of every non-blank text of ``raw`` that
    the typed view turns into null: numbers, dates and JSON lists."""
    from ..functions.json import entry_names

    def bad(name: str, typed: Column) -> Column:
        value = _blank_to_null(F.col(name))
        return F.when(value.isNotNull() & typed.isNull(), F.struct(F.lit(name).alias("column"), value.alias("value")))

    checks = [bad(c, F.col(c).try_cast("decimal(38,6)").try_cast("bigint")) for c in BIGINT_COLUMNS if c in raw.columns]
    checks += [bad(c, F.col(c).try_cast("double")) for c in DOUBLE_COLUMNS if c in raw.columns]
    checks += [bad(c, F.col(c).try_cast("date")) for c in ("release_date",) if c in raw.columns]
    checks += [bad(c, entry_names(c)) for c in JSON_COLUMNS if c in raw.columns]
    found = raw.select("id", "title", F.explode(F.array_compact(F.array(*checks))).alias("bad"))
    return found.select("id", "title", "bad.column", "bad.value")
