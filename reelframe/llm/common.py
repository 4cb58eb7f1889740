"""What the operators share: word rules, table access and shared storage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import drop_table, materialize
from ..plans.storage import table_path

# A word is a run of anything but space, tab, newline, vertical tab, form
# feed and carriage return: in Python exactly what ``bytes.split()`` gives.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started:
    unless PYTHONPATH has it, Spark sends it to them as a zip, once."""
    package, app = Path(__file__).resolve().parent.parent, spark.sparkContext.applicationId
    if app in _SHIPPED or not package.is_dir() or str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="reelframe-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` by workers that can import this package; a worker
    that stays alive gives back what Arrow keeps of a task's memory."""
    def task(batches):
        yield from run(batches)
        import pyarrow as pa

        pa.default_memory_pool().release_unused()

    ship(df.sparkSession)
    return df.mapInArrow(task, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage)."""
    return materialize(df, name)


class Rounds:
    """The table of an iteration: each round's replaces the one before, which
    is dropped once the new one is written."""

    def __init__(self, name: str):
        self.name, self.path = name, None

    def store(self, df: DataFrame) -> DataFrame:
        path = table_path(df.sparkSession, self.name)
        out = materialize(df, self.name, path=path)
        if self.path:
            drop_table(df.sparkSession, self.path)
        self.path = path
        return out


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_count(text: Column) -> Column:
    """Number of words of a text, null counting as empty (bigint)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def text_digest(text: Column) -> Column:
    """64-bit key that tells texts of one doc_id apart; null has its own."""
    return F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(text))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, id, digest)``: whole rows in one column, whatever their columns
    are called, beside the key that joins use."""
    text = F.col(text_col).cast("string")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.col(id_col).alias("id"), text_digest(text).alias("digest"))


def same_key(left: str, right: str) -> Column:
    """Join condition on (id, digest); null ids are equal."""
    return F.col(f"{left}.id").eqNullSafe(F.col(f"{right}.id")) & (F.col(f"{left}.digest") == F.col(f"{right}.digest"))
