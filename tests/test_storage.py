from __future__ import annotations

import os

from edge_fixture import write_csv
from reelframe import operators as op
from reelframe.plans import (SCALE_DEFAULTS, apply_defaults, checkpoint_dir, ensure_checkpoint_dir,
                             drop_table, dropped_tables, materialize)
from reelframe.sources import ingest_csv, read_films_csv, typed_films


def test_ingest_csv_writes_parquet_once(spark, scratch):
    csv_path = write_csv(scratch)
    out = os.path.join(scratch, "films.parquet")
    stored = ingest_csv(spark, csv_path, out)
    assert os.path.isdir(out) and stored.count() == 14
    assert stored.schema == read_films_csv(spark, csv_path).schema
    counts = {r.genre: r["count"] for r in op.genre_counts(typed_films(stored)).collect()}
    assert counts == {"Action": 3, "Drama": 7, "Music": 1, "Musical": 2}


def test_checkpoint_dir_comes_from_the_session(spark, scratch):
    configured = checkpoint_dir(spark)
    assert configured  # conftest: the session's setting, or a scratch folder if unset
    # An existing setting is kept; the fallback is only used when none is set.
    assert ensure_checkpoint_dir(spark, os.path.join(scratch, "unused")) == configured


def test_materialize_cuts_lineage_into_the_shared_folder(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    stored = materialize(df, "lineage-test")
    root = checkpoint_dir(spark).replace("file:", "")
    assert any(root.rstrip("/") in f.replace("file:", "") for f in stored.inputFiles())
    assert "FileScan parquet" in stored._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in stored.collect()) == list(range(100))


def test_dropped_tables_are_gone(spark, scratch):
    path = os.path.join(scratch, "table")
    materialize(spark.range(3).toDF("id"), "x", path=path)
    assert os.path.isdir(path)
    drop_table(spark, path)
    assert not os.path.exists(path)


def test_settings_helpers(spark):
    before = {k: spark.conf.get(k, None) for k in SCALE_DEFAULTS}
    try:
        apply_defaults(spark, {"spark.sql.shuffle.partitions": "8"})
        assert all(spark.conf.get(k) == v for k, v in SCALE_DEFAULTS.items())
    finally:
        for k, v in before.items():
            if v is not None:
                spark.conf.set(k, v)


def test_ingest_spreads_few_large_files(spark, scratch):
    from reelframe.sources import ingest_films
    raw = read_films_csv(spark, write_csv(scratch))  # one multi-line file: one task
    assert raw.rdd.getNumPartitions() == 1
    stored = ingest_films(raw, "spread", partitions=4)
    assert len(stored.inputFiles()) == 4
    counts = {r.genre: r["count"] for r in op.genre_counts(stored).collect()}
    assert counts == {"Action": 3, "Drama": 7, "Music": 1, "Musical": 2}


def test_tables_of_a_block_are_dropped_at_its_end(spark, scratch):
    kept = materialize(spark.range(2).toDF("id"), "kept")
    with dropped_tables(spark):
        inner = materialize(spark.range(5).toDF("id"), "inner")
        inner.write.parquet(f"{scratch}/out")
        files = inner.inputFiles()
    assert files and not any(os.path.exists(f.replace("file:", "")) for f in files)
    assert kept.count() == 2 and spark.read.parquet(f"{scratch}/out").count() == 5
    try:
        with dropped_tables(spark):
            files = materialize(spark.range(5).toDF("id"), "inner").inputFiles()
            raise ValueError
    except ValueError:
        pass
    assert files and not any(os.path.exists(f.replace("file:", "")) for f in files)
