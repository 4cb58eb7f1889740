"""Read the film CSV with the fixed all-text schema, and ingest it once.

The source file has no header, uses ``,`` as separator, ``"`` as quote
escape and ``\\N`` as null marker; quoted fields may hold newlines.
``multiLine`` makes a CSV file unsplittable; ``blocks`` reads it in many tasks
(``csv_blocks.py``). Either way a large input should be converted to Parquet
once (``ingest_csv``) and every analysis run on that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .csv_blocks import read_csv_blocks
from .schema import NULL_MARKER, RAW_SCHEMA

MALFORMED = "_malformed"


def read_films_csv(spark: SparkSession, path: str, *, multiline: bool = True, blocks: bool = False,
                   malformed: bool = False) -> DataFrame:
    """Raw film rows, every column text. ``multiline=False`` reproduces the
    line-wise reader, which splits records at embedded newlines; ``blocks``
    keeps them together and still splits the files, if their quotes are
    balanced. Missing fields of a short record are null; with ``malformed`` the
    column ``_malformed`` holds the text of records with too few or too many."""
    schema = StructType([*RAW_SCHEMA.fields, StructField(MALFORMED, StringType())]) if malformed else RAW_SCHEMA
    options = {"columnNameOfCorruptRecord": MALFORMED, "header": "false", "sep": ",", "quote": '"', "escape": '"',
               "nullValue": NULL_MARKER, "multiLine": str(multiline or blocks).lower(), "mode": "PERMISSIVE"}
    if blocks:
        return read_csv_blocks(spark, path, schema, options)
    return spark.read.schema(schema).options(**options).csv(path)


def malformed_records(spark: SparkSession, path: str, *, multiline: bool = True, blocks: bool = False) -> DataFrame:
    """``(id, title, record)`` of the records without exactly 20 fields."""
    rows = read_films_csv(spark, path, multiline=multiline, blocks=blocks, malformed=True)
    return rows.filter(F.col(MALFORMED).isNotNull()).select("id", "title", F.col(MALFORMED).alias("record"))


def write_films_csv(raw: DataFrame, path: str, *, compression: str = "none") -> None:
    """Raw film rows as CSV in the form that ``read_films_csv`` reads. A file
    with ``compression="gzip"`` is read by one task, and not by ``blocks``."""
    (raw.select(*RAW_SCHEMA.names).write.mode("overwrite").option("header", "false").option("quote", '"')
     .option("escape", '"').option("nullValue", NULL_MARKER).option("emptyValue", "").option("compression", compression).csv(path))


def ingest_csv(spark: SparkSession, csv_path: str, parquet_path: str, *, blocks: bool = False) -> DataFrame:
    """Convert the CSV to Parquet once (overwrite), return the Parquet scan.

    The write is a normal Spark job: task retries and the output committer
    make it safe against lost executors, and later scans are splittable,
    columnar and prune to the columns each analysis reads.
    """
    read_films_csv(spark, csv_path, blocks=blocks).write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)
