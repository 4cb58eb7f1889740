"""Top-k by bounded summaries, results of one cube, tables clustered by date
and exports that are resumed."""

from __future__ import annotations

import glob
import json
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from reelframe import operators as op
from reelframe import sinks
from reelframe.plans import materialize, shared_folder
from reelframe.sources import films_from_tables, ingest_films, load_films, read_films_csv, write_films_csv
from reelframe.sources.csv_blocks import record_texts


def keyword_films(spark, lists):
    rows = [(i, json.dumps([{"id": 1, "name": n} for n in names])) for i, names in enumerate(lists)]
    return spark.createDataFrame(rows, "id bigint, keywords string")


@pytest.mark.parametrize("tracked", [16, 10_000])
@pytest.mark.parametrize("kind", ["zipf", "flat", "ties", "few", "empty"])
def test_heavy_top_equals_the_plain_form(spark, kind, tracked):
    rnd = random.Random(3)
    lists = {
        "zipf": [[f"k{int(rnd.paretovariate(0.7))}" for _ in range(5)] for _ in range(2000)],
        "flat": [[f"k{rnd.randrange(4000)}" for _ in range(3)] for _ in range(2000)],
        "ties": [[f"k{i % 40}", f"rare{i}"] for i in range(1200)],
        "few": [["a", "b"], ["a", ""], [None, "c", None]],
        "empty": [[]],
    }[kind]
    films = keyword_films(spark, lists)
    got = op.heavy_top(films, "keywords", 10, buckets=64, tracked=tracked).collect()
    assert got == op.top_k(op.entry_counts(films, "keywords"), 10, "name").collect()


def test_rare_names_are_not_counted_one_by_one(spark):
    lists = [[f"k{i % 12}", f"rare{i}"] for i in range(6000)]
    names = keyword_films(spark, lists).select(F.explode(F.from_json("keywords", "array<struct<name:string>>").getField("name")).alias("name"))
    kept = op.heavy_names(names, "name", 10, buckets=512)
    left = {r.name for r in kept.select("name").distinct().collect()}
    assert {f"k{i}" for i in range(12)} <= left and len(left) < 100


def test_cube_results_equal_the_single_ones(spark):
    films = load_films(spark, SF_SMALL).withColumn("release_day", F.when(F.col("id") % 9 != 0, F.col("release_day")))
    cube = materialize(op.genre_cube(films), "cube-test")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(op.cube_counts(cube)) == rows(op.genre_counts(films))
    assert rows(op.cube_share(cube)) == rows(op.genre_share(films))
    assert rows(op.cube_entries_by_year(cube)) == rows(op.genre_entries_by_year(films))
    assert op.cube_share_by_year(cube, 1994, 1997).collect() == op.genre_share_by_year(films, 1994, 1997).collect()


def test_a_range_of_years_skips_files(spark, scratch):
    """Few files have days of the range, also where a third of the films share
    one day; results are those of the unclustered table."""
    raw = films_from_tables(spark, SF_SMALL)
    raw = raw.withColumn("release_date", F.when(F.col("id").cast("bigint") % 3 == 0, F.lit("1993-03-03")).otherwise(F.col("release_date")))
    films = ingest_films(raw, path=f"{scratch}/films", by_date=24)
    files = glob.glob(f"{scratch}/films/part-*.parquet")
    spans, sizes = [], []
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at = [meta.row_group(0).column(c).path_in_schema for c in range(meta.num_columns)].index("release_day")
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        spans.append((min(s.min for s in stats).year, max(s.max for s in stats).year))
        sizes.append(meta.num_rows)
    assert len(files) >= 20 and max(sizes) < 3 * sum(sizes) / len(sizes)
    assert sum(a <= 1997 and b >= 1996 for a, b in spans) <= len(files) / 3
    plain = ingest_films(raw, path=f"{scratch}/plain")
    assert op.genre_share_by_year(films, 1996, 1997).collect() == op.genre_share_by_year(plain, 1996, 1997).collect()


def test_finished_jobs_are_skipped_under_the_same_name_only(spark, scratch):
    films = ingest_films(films_from_tables(spark, SF_SMALL), "resume-films")
    calls = []

    def counted(name, fails=False):
        def run(f):
            calls.append(name)
            return f.select(F.raise_error(F.lit("no")).alias("x")) if fails else op.genre_counts(f)
        return sinks.Job(run, f"{name}.json")

    jobs = {"a": counted("a"), "b": counted("b")}
    with pytest.raises(PySparkException):
        sinks.run_jobs(films, scratch, {**jobs, "b": counted("b", True)}, run="r1")
    assert sinks.finished_jobs(spark, scratch, "r1") == {"a"} and calls == ["a", "b"]
    assert set(sinks.run_jobs(films, scratch, jobs, run="r1")) == {"a", "b"} and calls == ["a", "b", "b"]
    sinks.run_jobs(films, scratch, jobs, run="r2", parallelism=2)
    assert sorted(calls[3:]) == ["a", "b"] and not sinks.finished_jobs(spark, scratch, "r1")
    # A run without a name leaves results that belong to no run.
    sinks.run_jobs(films, scratch, {"a": jobs["a"]})
    assert sinks.finished_jobs(spark, scratch, "r2") == {"b"}
    with pytest.raises(ValueError):
        sinks.run_jobs(films, scratch, jobs, run="../x")


def test_whole_films_equal_those_of_one_aggregate_per_list(spark, scratch):
    """Keys that repeat, are null or have no dimension row; fewer shuffles."""
    day = "timestamp '1996-01-02 00:00:00'"
    tables = {
        "orders": ("o_orderkey bigint, o_totalprice double, o_orderstatus string, o_orderpriority string",
                   [(1, 15000.0, "F", "1-URGENT"), (2, 25000.0, "O", None), (2, 5.0, "O", "x"), (3, None, None, "y"), (None, 1.0, "P", "z")]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_discount double, l_tax double",
                     [(1, 1, 1, 3.0, 10.5, 0.1, 0.2), (1, 2, 2, 4.0, 20.25, 0.05, 0.1), (1, 1, 1, 3.0, 10.5, 0.1, 0.2),
                      (2, 9, 3, 1.0, 1.0, 0.0, 0.0), (2, None, None, None, None, None, None), (None, 1, 1, 1.0, 1.0, 0.0, 0.0)]),
        "part": ("p_partkey bigint, p_type string, p_name string", [(1, "ECONOMY", "a b"), (1, "LARGE", "c d"), (2, None, None), (None, "x", "y")]),
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey int", [(1, "S1", 7), (1, "S1b", 8), (2, "S2", None), (3, "S3", 99)]),
        "nation": ("n_nationkey int, n_name string", [(7, "PERU"), (7, "PERU2"), (8, None), (None, "NONE")]),
    }
    for name, (schema, rows) in tables.items():
        df = spark.createDataFrame(rows, schema)
        (df.selectExpr("*", f"{day} as o_orderdate") if name == "orders" else df).write.parquet(f"{scratch}/{name}.parquet")
    one, each = films_from_tables(spark, scratch, whole=True), films_from_tables(spark, scratch)
    text = lambda df: sorted(map(repr, df.collect()))
    assert one.columns == each.columns and len(text(one)) == 5 and text(one) == text(each)
    scans = lambda df: df._jdf.queryExecution().sparkPlan().toString().count("lineitem.parquet")
    assert scans(one) < scans(each)


def test_compressed_csv_is_read_as_written(spark, scratch):
    raw = films_from_tables(spark, SF_SMALL).drop("release_day")
    write_films_csv(raw, f"{scratch}/plain")
    write_films_csv(raw, f"{scratch}/gzip", compression="gzip")
    plain, packed = (read_films_csv(spark, f"{scratch}/{k}", multiline=False) for k in ("plain", "gzip"))
    assert plain.exceptAll(packed).count() == 0 and packed.count() == raw.count()
    size = lambda k: sum(f.stat().st_size for f in Path(scratch, k).glob("part-*"))
    assert size("gzip") * 4 < size("plain")


def test_clustering_computes_the_films_once(spark, scratch):
    """The sample of the ranges is a job of its own: it must not compute the
    input again, and the table that it reads is dropped."""
    raw = films_from_tables(spark, SF_SMALL)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    films = ingest_films(raw.mapInArrow(count, raw.schema), "films-once", path=f"{scratch}/films", by_date=4)
    assert films.count() == raw.count() == seen.value
    assert not list(Path(shared_folder(spark).removeprefix("file:"), "tables").glob("films-once-unclustered-*"))
    plain = ingest_films(raw, path=f"{scratch}/plain")
    assert films.columns == plain.columns and films.exceptAll(plain).count() == 0


def test_blocks_end_lines_as_before(spark, scratch):
    Path(scratch, "x.csv").write_bytes('a,"é\r\n""b"""\r\nc\r,d\r\n"e\n\n"\n'.encode())
    texts = sorted(r.record for r in record_texts(spark, f"{scratch}/x.csv").collect())
    assert texts == sorted(['a,"é\n""b"""', "c\r,d", '"e\n\n"'])


def test_one_part_of_the_csv_is_on_disk_at_a_time(spark, monkeypatch):
    """Each part's CSV is gone before the next is written, and all are read:
    as many rows as films, with the same values."""
    from reelframe.catalog import queries

    monkeypatch.setattr(queries, "CSV_FILMS", 400)
    tables, sizes, written = Path(shared_folder(spark).removeprefix("file:"), "tables"), [], []

    def write(raw, path, **options):
        sizes.append(len(list(tables.glob("films-csv-*/part-*"))))
        write_films_csv(raw, path, **options)
        written.append(spark.read.text(path).count())

    before = len(list(tables.glob("films-csv-*/part-*")))
    monkeypatch.setattr(queries, "write_films_csv", write)
    got = queries.csv_blocks_roundtrip(spark, SF_SMALL)
    want = queries._told(films_from_tables(spark, SF_SMALL, whole=True)).drop("release_day")
    assert len(written) == -(-want.count() // 400) > 1 and min(written) > 0 and set(sizes) == {before}
    assert len(list(tables.glob("films-csv-*/part-*"))) == before
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_the_lines_of_blocks_are_sorted_once_for_their_records(spark, scratch):
    Path(scratch, "x.csv").write_text('a,"b\nc"\n' * 50)
    plan = record_texts(spark, scratch)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
