"""Quirk rulings on the 14-record edge fixture, read through the CSV source."""

from __future__ import annotations

import pytest

from edge_fixture import record_ids, write_csv
from reelframe import operators as op
from reelframe.sources import malformed_records, read_films_csv, rejected_rows, rejected_values, typed_films


@pytest.fixture(scope="module")
def films(spark, tmp_path_factory):
    path = write_csv(str(tmp_path_factory.mktemp("edge")))
    return typed_films(read_films_csv(spark, path)).cache()


def as_dict(df, key="genre", value="count"):
    return {r[key]: r[value] for r in df.collect()}


def test_multiline_records(spark, tmp_path):
    path = write_csv(str(tmp_path))
    assert read_films_csv(spark, path).count() == 14
    # A line-wise read splits the record whose overview holds a newline (Q17).
    assert read_films_csv(spark, path, multiline=False).count() == 15


def test_entry_counts_a1(films):
    assert as_dict(op.genre_counts(films)) == {"Action": 3, "Drama": 7, "Music": 1, "Musical": 2}


def test_containment_counts_a2(films):
    assert as_dict(op.genre_counts_contains(films)) == {"Action": 4, "Drama": 6, "Music": 2, "Musical": 2}


def test_budget_top_tie_break_a5(films):
    got = [(r.budget, r["count"]) for r in op.budget_top(films, 10).collect()]
    assert got == [(300, 3), (100, 2), (200, 2), (400, 2), (500, 2), (600, 1)]


def test_budget_ordered_a5p(films):
    got = [r.budget for r in op.budget_ordered(films, "budget", True, 3).collect()]
    assert got == [100, 200, 300]
    with pytest.raises(ValueError):
        op.budget_ordered(films, "title")


def test_runtime_thresholds_a6(films):
    strict = [(r.runtime, r["count"]) for r in op.runtime_common(films, 2, strict=True).collect()]
    inclusive = [(r.runtime, r["count"]) for r in op.runtime_common(films, 2, strict=False).collect()]
    assert strict == [(90, 3), (95, 3), (100, 3)]
    assert inclusive == [(90, 3), (95, 3), (100, 3), (101, 2)]


def test_languages_blank_kept_or_dropped_a8(films):
    assert as_dict(op.language_top(films, 10), "language") == {"English": 8, "": 2, "Français": 1}
    assert as_dict(op.language_top(films, 10, drop_blank=True), "language") == {"English": 8, "Français": 1}


def test_point_filters(films):
    assert record_ids(op.budget_vs_rating(films)) == [1, 2, 5, 6, 7, 8, 10, 11, 12, 14]
    assert record_ids(op.budget_vs_rating_voted(films)) == [1, 2, 4, 6, 7, 8, 11, 12, 13, 14]
    assert record_ids(op.release_vs_rating(films)) == [1, 2, 3, 5, 6, 7, 8, 10, 11, 12, 14]
    assert record_ids(op.release_vs_rating_voted(films)) == [1, 2, 3, 4, 6, 8, 11, 12, 13, 14]


def test_title_with_quote_is_escaped_in_json(films):
    from reelframe.sinks import json_lines
    lines = [r.json for r in json_lines(op.budget_vs_rating(films).filter("budget = 100")).collect()]
    assert any('Say \\"Hi\\"' in x for x in lines)


def test_genre_share_by_year_a17(films):
    got = {(r.genre, r.year): r.ratio for r in op.genre_share_by_year(films, 2005, 2015).collect()}
    assert got == pytest.approx({
        ("Music", 2005): 0.5, ("Musical", 2005): 0.5,
        ("Action", 2009): 1 / 3, ("Drama", 2009): 2 / 3,
        ("Action", 2010): 0.5, ("Drama", 2010): 0.5,
        ("Drama", 2011): 1.0, ("Musical", 2015): 1.0,
    })


def test_genre_year_counts_a20(films):
    got = {(r.genre, r.release_year): r["count"] for r in op.genre_year_counts(films).collect()}
    assert got == {
        ("Action", "2009"): 1, ("Action", "2010"): 1, ("Action", "2011"): 1, ("Action", "2016"): 1,
        ("Drama", "2004"): 1, ("Drama", "2009"): 3, ("Drama", "2010"): 1, ("Drama", "2011"): 1,
        ("Music", "2005"): 1, ("Music", "2015"): 1, ("Musical", "2005"): 1, ("Musical", "2015"): 1,
    }


def test_rejected_genres(films):
    assert sorted(int(r.id) if r.id is not None else 9 for r in rejected_rows(films).collect()) == [6, 9]


def test_header_like_record_is_not_data(films):
    # Record 9 has text where numbers belong: every typed column is null.
    row = films.filter("title = 'title'").collect()[0]
    assert row.budget is None and row.vote_average is None and row.release_day is None


def test_typed_view_is_idempotent(films):
    again = typed_films(films)
    assert again.schema == films.schema
    assert sorted(map(repr, again.collect())) == sorted(map(repr, films.collect()))


def test_chart_shapes(films):
    labels = {r.runtime: r.label for r in op.runtime_labels(films, 2).collect()}
    assert labels == {90: "90 min.", 95: "95 min.", 100: "100 min."}
    dates = {r.title: r.label for r in op.release_date_labels(films).collect()}
    assert dates["Say \"Hi\""] == "2009-1-1" and dates["BadDate"] is None
    share = op.language_top_share(films, 10).collect()
    assert abs(sum(r.share for r in share) - 1.0) < 1e-12 and {r.language for r in share} == {"English", "", "Français"}
    weights = {r.language: r.weight for r in op.scaled(op.language_top(films, 10)).collect()}
    assert weights == {"English": 40.0, "": pytest.approx(24 + 16 / 7), "Français": 24.0}
    money = op.millions(films).filter("title = 'Plain'").collect()[0]
    assert money.budget_millions == 100 / 1e6 and money.revenue_millions == 10 / 1e6
    rounded = op.company_rating_rounded(films).collect()
    assert rounded == []  # the fixture lists no companies


def test_genre_year_matrix_fills_missing_cells(films):
    grid = {r.genre: r.asDict() for r in op.genre_year_matrix(films, 2009, 2011).collect()}
    assert grid["Drama"]["2011"] == 1.0 and grid["Action"]["2011"] == 0.0
    assert grid["Action"]["2009"] == pytest.approx(1 / 3)


def test_readable_numbers_and_dates_are_kept(spark):
    rows = [("1", "a", "10.0", "90.0", "2009-1-5", "7.5"), ("2", "b", "1e3", " 95 ", "2009", "8"), ("3", "c", "ten", "", "2009-13-40", "x"),
            ("4", "d", None, "99999999999999999999999", "", None)]
    raw = spark.createDataFrame(rows, "id string, title string, budget string, runtime string, release_date string, vote_average string")
    got = {r.id: (r.budget, r.runtime, str(r.release_day), r.vote_average) for r in typed_films(raw).collect()}
    assert got == {1: (10, 90, "2009-01-05", 7.5), 2: (1000, 95, "2009-01-01", 8.0), 3: (None, None, "None", None),
                   4: (None, None, "None", None)}
    bad = {(r.id, r.column): r.value for r in rejected_values(raw).collect()}
    assert bad == {("3", "budget"): "ten", ("3", "release_date"): "2009-13-40", ("3", "vote_average"): "x",
                   ("4", "runtime"): "99999999999999999999999"}


def test_rejected_values_of_the_fixture(spark, tmp_path):
    raw = read_films_csv(spark, write_csv(str(tmp_path)))
    bad = {(r.title, r.column) for r in rejected_values(raw).collect()}
    assert {("BadJson", "genres"), ("BadDate", "release_date"), ("title", "budget"), ("title", "release_date")} <= bad
    assert {t for t, _ in bad} == {"BadJson", "BadDate", "title"}


def test_short_and_long_records_are_reported(spark, tmp_path):
    path = tmp_path / "films.csv"
    with open(write_csv(str(tmp_path))) as whole:
        text = whole.read()
    path.write_text("1,[],x,77\n" + text)
    assert read_films_csv(spark, str(path)).count() == 15
    assert [r.record for r in malformed_records(spark, str(path)).collect()] == ["1,[],x,77"]


def test_matrix_is_cut_not_rounded(films):
    grid = {r.genre: r.asDict() for r in op.genre_year_matrix(films, 2009, 2009, decimals=3).collect()}
    assert grid["Drama"]["2009"] == 0.666 and grid["Action"]["2009"] == 0.333
