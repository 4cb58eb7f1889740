"""Layout of the film table as it arrives from the source (all text)."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# The 20 source columns, in file order. The CSV has no
# header, so this order is the only way to name the fields.
RAW_COLUMNS: tuple[str, ...] = (
    "budget", "genres", "homepage", "id", "keywords", "original_language",
    "original_title", "overview", "popularity", "production_companies",
    "production_countries", "release_date", "revenue", "runtime",
    "spoken_languages", "status", "tagline", "title", "vote_average",
    "vote_count",
)

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

# How the text columns are read.
BIGINT_COLUMNS: tuple[str, ...] = ("budget", "id", "revenue", "runtime", "vote_count")
DOUBLE_COLUMNS: tuple[str, ...] = ("popularity", "vote_average")
NULL_MARKER = "\\N"

# JSON-in-text columns: an array of objects that each carry a "name".
# The id-bearing element schema is the one the source analyses parse with;
# spoken_languages has no numeric id, so only its name is declared.
ENTRY_SCHEMA = "array<struct<id:int,name:string>>"
NAME_SCHEMA = "array<struct<name:string>>"
JSON_COLUMNS: dict[str, str] = {
    "genres": ENTRY_SCHEMA,
    "keywords": ENTRY_SCHEMA,
    "production_companies": ENTRY_SCHEMA,
    "spoken_languages": NAME_SCHEMA,
}

# Stored name arrays written by ``ingest_films``: ``<column>_names``.
NAMES_SUFFIX = "_names"
