"""Where intermediate tables go, and how lineage is cut.

The cluster names a shared folder in ``spark.checkpoint.dir``; intermediate
tables are written there (never to a machine-local temporary folder), so
they survive the loss of any executor. Only when the setting is absent, as
in a local test session, does ``ensure_checkpoint_dir`` set one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CONF_KEY = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder configured for this session, if any."""
    configured = spark.conf.get(CONF_KEY, None)
    if configured:
        return configured
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the configured folder; set ``fallback`` only when none is configured."""
    found = checkpoint_dir(spark)
    if found:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(found)
        return found
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set(CONF_KEY, fallback)
    return fallback


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a session in one local
    process, as in tests, may get a temporary folder when none is set."""
    found = checkpoint_dir(spark)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"{CONF_KEY} is not set; configure a shared folder for intermediate tables")
        found = tempfile.mkdtemp(prefix="reelframe-")
    return ensure_checkpoint_dir(spark, found)


_MADE: ContextVar[list[str] | None] = ContextVar("tables made", default=None)


def table_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table in the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    if _MADE.get() is not None:
        _MADE.get().append(path)
    return path


@contextmanager
def dropped_tables(spark: SparkSession) -> Iterator[None]:
    """Drops, at its end, the intermediate tables that its thread has made
    inside: for a result that is written before the end. A failed block
    drops its tables too. Blocks may be nested."""
    made: list[str] = []
    outer = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(outer)
        for path in made:
            drop_table(spark, path)


def materialize(df: DataFrame, name: str, *, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder (or to ``path``) and
    return a scan of it. Cuts lineage: later jobs read the table instead of
    recomputing ``df``."""
    spark = df.sparkSession
    path = path or table_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table, wherever Spark's file system has it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
