"""CSV by byte ranges against the multi-line reader and Python's csv."""

from __future__ import annotations

import csv
import io
import os
import random
from contextlib import contextmanager

import pytest

import edge_fixture
from reelframe.sources import ingest_csv, malformed_records, read_films_csv
from reelframe.sources.csv_blocks import record_texts
from reelframe.sources.schema import RAW_COLUMNS


@contextmanager
def split_size(spark, size):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def rows_of(df):
    return sorted(df.collect(), key=str)


def write(folder, name, rows, end="\n"):
    path = os.path.join(folder, name)
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end).writerows(rows)
    return path


@pytest.mark.parametrize("size", [64, 333, 1 << 20])
def test_edge_fixture_reads_as_the_multi_line_reader_has_it(spark, scratch, size):
    path = edge_fixture.write_csv(scratch)
    with split_size(spark, size):
        got = read_films_csv(spark, path, blocks=True)
        assert got.columns == list(RAW_COLUMNS)
        assert rows_of(got) == rows_of(read_films_csv(spark, path))


def test_records_over_many_blocks_and_files(spark, scratch):
    rnd = random.Random(11)
    field = lambda: "".join(rnd.choice(["a", "\n", '"', ",", "é", " ", "\n\n", '"\n', "日本"]) for _ in range(rnd.randint(1, 12)))
    want = []
    for f in range(3):
        rows = [["x" + field() + "x" for _ in range(20)] for _ in range(40 * f + 1)]
        rows[0][7] = "one field over many blocks\n" * 60 + '"'
        want += rows
        write(scratch, f"part-{f}.csv", rows)
    for size in (50, 211, 1024):
        with split_size(spark, size):
            texts = record_texts(spark, scratch)
            assert texts.count() == len(want)
            blocks = spark.read.text(scratch).rdd.getNumPartitions() if size == 1024 else 10
            assert blocks > 3  # more than one task per file
            got = read_films_csv(spark, scratch, blocks=True).collect()
        assert sorted(map(list, got)) == sorted(want)
    assert sorted(map(list, read_films_csv(spark, scratch).collect())) == sorted(want)


def test_record_texts_are_the_files_records(spark, scratch):
    rows = [[f"{i}", "q\"uo,te\nd" * (i % 5), "z"] for i in range(200)]
    path = write(scratch, "a.csv", rows)
    with split_size(spark, 97):
        texts = [r.record for r in record_texts(spark, path).collect()]
    assert sorted(next(csv.reader(io.StringIO(t, newline=""))) for t in texts) == sorted(rows)


def test_carriage_returns_and_empty_lines(spark, scratch):
    rows = [[f"{i}\r\nx" if i % 3 == 0 else f"{i}"] + ["v"] * 19 for i in range(60)]
    path = write(scratch, "crlf.csv", rows, "\r\n")
    with open(path, "a", newline="") as out:
        out.write("\r\n\r\n")
    with split_size(spark, 128):
        got = read_films_csv(spark, path, blocks=True).collect()
    assert sorted(r.budget for r in got) == sorted(r[0].replace("\r\n", "\n") for r in rows)


def test_malformed_records_and_ingest(spark, scratch):
    path = edge_fixture.write_csv(scratch)
    with open(path, "a", encoding="utf-8") as out:
        out.write('1,"two\nlines",3\n' + ",".join("x" * 25) + "\n")
    with split_size(spark, 200):
        assert rows_of(malformed_records(spark, path, blocks=True)) == rows_of(malformed_records(spark, path))
        stored = ingest_csv(spark, path, os.path.join(scratch, "out"), blocks=True)
    assert rows_of(stored) == rows_of(read_films_csv(spark, path))


def test_empty_files(spark, scratch):
    path = write(scratch, "none.csv", [])
    assert read_films_csv(spark, path, blocks=True).collect() == []
