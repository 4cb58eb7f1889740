from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import PySparkException

from conftest import SF_SMALL
from reelframe import operators as op
from reelframe import sinks
from reelframe.sources import films_from_tables, ingest_films


@pytest.fixture(scope="module")
def films(spark):
    return ingest_films(films_from_tables(spark, SF_SMALL), "sink-test-films")


def joined(path):
    """The part files of a result, one after the other."""
    return "".join(open(os.path.join(path, f), encoding="utf-8").read() for f in sorted(os.listdir(path)) if f.startswith("part-"))


def test_document_is_valid_json_in_order(films):
    doc = sinks.json_document(op.budget_top(films, 10), 10, order=["count", "budget"],
                              descending=[True, False]).collect()[0].document
    rows = json.loads(doc)
    assert rows == [r.asDict() for r in op.budget_top(films, 10).collect()]


def test_document_refuses_unbounded_result(films):
    with pytest.raises(PySparkException):
        sinks.json_document(op.budget_vs_rating(films), 5).collect()


def test_empty_document_is_empty_array(films):
    doc = sinks.json_document(op.budget_top(films, 10).limit(0), 10).collect()[0].document
    assert json.loads(doc) == []


def test_parallel_arrays_in_key_order(films):
    row = sinks.parallel_arrays(op.revenue_total_by_year(films, 1995, 2001), "year", "total_revenue", 7).collect()[0]
    years, values = json.loads(row["keys"]), json.loads(row["values"])
    expected = [(r.year, r.total_revenue) for r in op.revenue_total_by_year(films).collect()]
    assert list(zip(years, values)) == expected


def test_console_lines(films):
    lines = [r.line for r in sinks.console_lines(op.genre_year_counts(films), "genre", "release_year", "count").collect()]
    assert lines and all(line.endswith("&") and line.count(",") == 2 for line in lines)


@pytest.mark.parametrize("parallelism", [1, 4])
def test_run_jobs_writes_every_file(films, scratch, parallelism):
    written = sinks.run_jobs(films, scratch, parallelism=parallelism)
    assert set(written) == set(sinks.DEFAULT_JOBS)
    texts = {}
    for name, path in written.items():
        assert os.path.isdir(path) and any(f.startswith("part-") for f in os.listdir(path))
        texts[name] = json.loads(joined(path))  # every file is one JSON array
    assert texts["budget"] == [r.asDict() for r in op.budget_ordered(films, k=10).collect()]
    assert sorted(map(tuple, texts["budget_vote"])) == sorted(map(tuple, op.budget_vs_rating_voted(films).collect()))
    assert {len(x) for x in texts["movies_vote"]} == {3}
    assert texts["runtime"] == [r.asDict() for r in op.runtime_common(films, 100, strict=False).collect()]


def test_null_fields_are_written(spark, scratch):
    df = spark.createDataFrame([("A", None, 'q"'), (None, 2.5, "b")], "title string, popularity double, note string")
    assert [r.json for r in sinks.json_lines(df).collect()] == ['{"title":"A","popularity":null,"note":"q\\""}', '{"title":null,"popularity":2.5,"note":"b"}']
    assert [json.loads(r.json) for r in sinks.array_lines(df).collect()] == [["A", None, 'q"'], [None, 2.5, "b"]]
    sinks.write_json(df, scratch + "/nulls")
    back = [json.loads(x) for f in sorted(os.listdir(scratch + "/nulls")) if f.startswith("part-") for x in open(os.path.join(scratch, "nulls", f))]
    assert sorted(map(str, back)) == sorted(map(str, [r.asDict() for r in df.collect()]))


def test_command_line_runs_selected_jobs(spark, scratch):
    from edge_fixture import write_csv
    from reelframe.__main__ import main
    out = os.path.join(scratch, "out")
    written = main(["--csv", write_csv(scratch), "--out", out, "--jobs", "genres", "budget",
                    "--parallelism", "2"])
    assert set(written) == {"genres", "budget"}
    assert {r["genre"]: r["count"] for r in json.loads(joined(written["genres"]))} == {"Action": 3, "Drama": 7, "Music": 1, "Musical": 2}


def test_command_line_reuses_a_stored_table_and_drops_its_own(spark, scratch):
    from edge_fixture import write_csv
    from reelframe.__main__ import main
    from reelframe.plans import checkpoint_dir

    tables = os.path.join(checkpoint_dir(spark).replace("file:", ""), "tables")
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    csv_path, stored = write_csv(scratch), os.path.join(scratch, "stored")
    main(["--csv", csv_path, "--out", os.path.join(scratch, "a"), "--jobs", "genres"])
    assert (set(os.listdir(tables)) if os.path.isdir(tables) else set()) == before
    main(["--csv", csv_path, "--out", os.path.join(scratch, "b"), "--jobs", "genres", "--stored", stored])
    os.rename(csv_path, csv_path + ".gone")
    main(["--csv", csv_path, "--out", os.path.join(scratch, "c"), "--jobs", "genres", "--stored", stored])
    read = lambda d: sorted(map(str, json.loads(joined(os.path.join(scratch, d, "genres.json")))))
    assert read("a") == read("b") == read("c") != []


ROWS = [(f"t{i % 7}", i % 5, None if i % 3 else 'q"\n,]' + "é") for i in range(200)] + [("same", 1, None)] * 50


@pytest.mark.parametrize("partitions", [1, 5])
@pytest.mark.parametrize("n", [0, 1, 2, 250])
def test_parts_of_an_array_are_one_array(spark, scratch, n, partitions):
    df = spark.createDataFrame(ROWS[-n:] if n else [], "title string, rank int, note string").repartition(partitions)
    path = os.path.join(scratch, "points.json")
    sinks.write_json_array(df, path, points=True)
    assert sorted(map(str, json.loads(joined(path)))) == sorted(str(list(r)) for r in df.collect())
    sinks.write_json_array(df, path, order=("rank", "title"), descending=(True,))
    rows = json.loads(joined(path))
    assert [(-r["rank"], r["title"]) for r in rows] == sorted((-r["rank"], r["title"]) for r in rows)
    assert sorted(map(str, rows)) == sorted(str(r.asDict()) for r in df.collect())


def test_an_array_gathers_nothing(spark, films, scratch):
    """A point table's elements stay in several part files."""
    path = os.path.join(scratch, "many.json")
    df = op.budget_vs_rating_voted(films).repartition(6)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        sinks.write_json_array(df, path, points=True)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    sizes = [os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-")]
    assert len(sizes) > 4 and max(sizes) < 0.6 * sum(sizes)
    assert len(json.loads(joined(path))) == df.count()


def _failing(spark):
    return spark.range(100).selectExpr("if(id = 77, raise_error('lost'), id) as value")


@pytest.mark.parametrize("write", [sinks.write_json, sinks.write_json_array])
def test_a_failed_job_leaves_the_old_result(spark, scratch, write):
    path = os.path.join(scratch, "r")
    write(spark.range(3).toDF("value"), path)
    old = joined(path)
    with pytest.raises(Exception, match="lost"):
        write(_failing(spark), path)
    assert joined(path) == old and os.listdir(scratch) == ["r"] and sinks.current(spark, path) == path
    write(spark.range(1).toDF("value"), path)
    assert joined(path) != old and os.listdir(scratch) == ["r"]


def test_a_replacement_broken_off_between_renames(spark, scratch):
    path = os.path.join(scratch, "r")
    sinks.write_text(spark.createDataFrame([("old",)], "value string"), path)
    os.rename(path, os.path.join(scratch, ".r.old-1"))  # as if the driver died here
    found = sinks.current(spark, path)
    assert [r.value for r in spark.read.text(found).collect()] == ["old"]
    sinks.write_text(spark.createDataFrame([("new",)], "value string"), path)
    assert joined(path) == "new\n" and os.listdir(scratch) == ["r"]
    with pytest.raises(FileNotFoundError):
        sinks.current(spark, os.path.join(scratch, "never"))


def test_sums_above_64_bits(spark):
    rows = [(2**62, 2001)] * 5 + [(2**62 + 1, 2001), (3, 2002), (None, 2002)]
    films = spark.createDataFrame(rows, "revenue long, y int").selectExpr("revenue", "make_date(y, 1, 1) as release_day")
    assert [(r.year, int(r.total_revenue)) for r in op.revenue_total_by_year(films).collect()] == [(2001, 6 * 2**62 + 1), (2002, 3)]
    assert [r.avg_revenue for r in op.revenue_mean_by_year(films).collect()] == [float(6 * 2**62 + 1) / 6, 3.0]


def test_company_means_do_not_depend_on_the_order(spark):
    rows = [("1", '[{"name": "A", "id": 1}]', r, 500) for r in (0.1, 0.2, 0.3, 6.7, 9.9, 1e-7, 3.3) * 9]
    schema = "id string, production_companies string, vote_average double, vote_count long"
    means = {op.company_rating(spark.createDataFrame(rows[::step], schema).repartition(n)).collect()[0].average for step in (1, -1) for n in (1, 4, 7)}
    assert len(means) == 1
