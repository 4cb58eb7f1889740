"""Corpus pipeline: documents in, packed training sequences out.

``STAGES`` are run in order; each takes the whole output of the one before,
written as Parquet and read again, and every stage but the last returns the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm.common import documents
from reelframe.llm.langid import fit, identify, training_rows
from reelframe.llm.line_templates import drop_recurring
from reelframe.llm.mixing import mixed
from reelframe.llm.packing import pack_documents
from reelframe.llm.simhash import one_per_component
from reelframe.plans.config import settings
from reelframe.plans.storage import drop_table, dropped_tables, table_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; ``und`` (null and empty texts,
    texts without a letter) and narrow margins go. Repeated rows get one
    answer each; without labelled rows nothing is identified."""
    found = identify(docs, fit(training_rows(docs)))
    return found.filter(~F.col("lang_rejected")).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the repeated lines of recurring templates; ``n_chars``
    follows the text. Every row stays, also one that loses all its lines, and
    null and empty texts."""
    out = drop_recurring(docs).select(*[F.col(f"`{c}`") for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash near-duplicates: 3-word
    shingles, at most 2 bits apart. Texts without words are all of one
    component; of repeated rows one stays; ids may be null or shared."""
    return one_per_component(docs, shingle=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, 0 to 3 times; one
    without words once. Null is a source of its own, the last."""
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, also of empty and null texts and of repeated
    rows, and their places in sequences of 1024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# Whole texts in one Arrow batch: buffers outside the heap, on both sides,
# grow with it and are kept for the stages that follow.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}

# Compression, fingerprints and rounding have no SQL form: tests hold the
# stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` to the documents of ``sf_dir``; the outputs between
    them are tables in the shared folder. Once a stage's output is written,
    its helper tables and its input go; the last stage's stay, since the
    result reads them."""
    folder = table_path(spark, "pipeline")
    docs, before = documents(spark, sf_dir), None
    for k, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{k}-{name}"
        with dropped_tables(spark), settings(spark, ARROW):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            drop_table(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
