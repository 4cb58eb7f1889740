"""S1 in many tasks: a CSV with newlines in quoted fields, read by byte range.

Spark's multi-line reader takes a file as one task, because only the quotes
before a newline tell whether it ends a record. The line reader does split a
file: here every task reads the lines of its byte ranges, and the quotes
settle what the newlines mean.

1. A running parity of the quotes over the lines of each block (file, start of
   the byte range) tells, for either state that it may begin in, the first and
   the last line that begin a record; a prefix sum of the blocks' parities over
   a file (one small row per block) tells which begin inside a quoted field.
2. From a block's first such line on, a running parity tells which lines begin
   a record; the lines of one record are folded into one text, inside the block.
3. A record that runs over the end of its block is put together from its
   parts: at most one open end and one open begin per block. Only their lines
   are sought for this.
4. Each record is parsed by ``from_csv``.

The text is scanned three times and shuffled once, by block. Quotes must be balanced
as CSV writers leave them (a field with a quote is quoted, its quotes are
doubled); a file that has them otherwise needs the multi-line reader. Lines
end in ``\\n`` or ``\\r\\n``; inside a field both read as ``\\n``. Empty lines
between records are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QUOTE = '"'


def _odd_quotes(line: Column) -> Column:
    """1 if the line has an odd number of quotes, else 0."""
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(QUOTE), F.lit("")))) % 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, n, line)``: the lines of each byte range, ``n`` in
    their order there (a task numbers the lines that it reads)."""
    text = spark.read.option("lineSep", "\n").text(path)
    line = F.when(F.col("value").contains("\r"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("n"), line.alias("line"))


def _block_marks(lines: DataFrame) -> DataFrame:
    """``(file, block, first, last, open)``: the numbers of the first and the
    last line of a block that begin a record (null: none does), and whether
    the block ends in a quoted field."""
    odd = lines.select("file", "block", "n", _odd_quotes(F.col("line")).alias("odd"))
    upto = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    state = odd.withColumn("state", (F.sum("odd").over(upto) - F.col("odd")) % 2)
    ends = [f(F.when(F.col("state") == k, F.col("n"))).alias(f"{name}{k}") for k in (0, 1) for name, f in (("first", F.min), ("last", F.max))]
    blocks = state.groupBy("file", "block").agg(F.sum("odd").alias("odd"), *ends)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    pick = lambda name: F.when(F.col("inside") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1")).alias(name)
    return blocks.withColumn("inside", inside).select("file", "block", pick("first"), pick("last"),
                                                      ((F.col("inside") + F.col("odd")) % 2 == 1).alias("open"))


def _folded(parts: Column) -> Column:
    """The texts of ``(order, text)`` structs, in order, a newline between."""
    return F.concat_ws("\n", F.array_sort(F.collect_list(parts)).getField("text"))


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """``(record)``: the text of every record of the CSV files at ``path``,
    newlines inside quoted fields included."""
    lines = _lines(spark, path)
    # The marks are a row per block; lines have the same numbers in every scan of a plan.
    marked = lines.join(F.broadcast(_block_marks(lines)), ["file", "block"])
    here = F.coalesce(F.col("n") >= F.col("first"), F.lit(False))
    tail = F.col("open") & here & (F.col("n") >= F.col("last"))

    in_block = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    inner = marked.filter(here & ~tail).select("file", "block", "n", "line")
    begins = (F.sum(_odd_quotes(F.col("line"))).over(in_block) - _odd_quotes(F.col("line"))) % 2 == 0
    numbered = inner.withColumn("begins", begins.cast("int")).withColumn("record", F.sum("begins").over(in_block))
    whole = numbered.groupBy("file", "block", "record").agg(_folded(F.struct("n", F.col("line").alias("text"))).alias("record_text"))

    # What a block's first lines add to a record before them, and its open end.
    ends = marked.filter(~here | tail).groupBy("file", "block", tail.alias("tail")).agg(
        _folded(F.struct("n", F.col("line").alias("text"))).alias("text"))
    along = Window.partitionBy("file").orderBy("block", "tail")
    head = F.last(F.when(F.col("tail"), F.col("block")), ignorenulls=True).over(along)
    joined = ends.withColumn("head", head).groupBy("file", "head").agg(_folded(F.struct("block", "text")).alias("record"))
    return whole.select(F.col("record_text").alias("record")).unionByName(joined.select("record")).filter("record <> ''")


def read_csv_blocks(spark: SparkSession, path: str, schema: StructType, options: dict[str, str]) -> DataFrame:
    """The records of the CSV files at ``path``, parsed by ``from_csv`` with
    ``options``; any number of tasks per file."""
    parsed = F.from_csv("record", F.lit(schema.simpleString()), options).alias("row")
    return record_texts(spark, path).select(parsed).select("row.*")
