"""Containment against brute force ``name in text or in a decoded name``."""

from __future__ import annotations

import json

import pytest

from reelframe import operators as op
from reelframe.sources import load_films, typed_films

GENRES = [["A"], ["TV Movie", "Drama"], ["TV"], ["Action", "A"], ["Drama"], [], ["Adventure", "TV"],
          ["Dramatic"], ["Mystery", "Drama", "Action"], ["Comédie"], ['Film "Noir"'], ["", "Ac", "Act"], ["Noir"], ["a\\b"],
          ["100%"], ["日本"], ["日本映画", "Comédie"]]


@pytest.fixture(scope="module")
def small(spark):
    rows = [(str(i), json.dumps([{"id": j, "name": n} for j, n in enumerate(g)]),
             f"{2000 + i % 3}-01-01") for i, g in enumerate(GENRES)]
    rows.append(("99", '[{"name": "Drama"', "2001-01-01"))  # does not parse: searched as it is
    rows.append(("98", None, "2001-01-01"))
    return spark.createDataFrame(rows, "id string, genres string, release_date string")


def brute(names):
    counts = {}
    texts = [(json.dumps([{"id": j, "name": n} for j, n in enumerate(g)]), g) for g in GENRES] + [('[{"name": "Drama"', [])]
    for i, (text, decoded) in enumerate(texts):
        for n in names:
            if n in text or any(n in d for d in decoded):
                key = (n, "2001" if i == len(GENRES) else str(2000 + i % 3))
                counts[key] = counts.get(key, 0) + 1
    return counts


NAMES = {n for g in GENRES for n in g}


def test_contains_counts_match_brute_force(small):
    want = {}
    for (n, _), c in brute(NAMES - {""}).items():
        want[n] = want.get(n, 0) + c
    assert {r.genre: r["count"] for r in op.genre_counts_contains(small).collect()} == want


def test_contains_year_counts_match_brute_force(small):
    got = {(r.genre, r.release_year): r["count"] for r in op.genre_year_counts(small).collect()}
    assert got == brute(NAMES - {""})


@pytest.mark.parametrize("names", [["", "A", "Ac", "Act", "Action"], ["Noir"], [], ['"N', "é", "ie\"}"],
                                   ['"', "name", ", {", ': "', "\\", "}", " ", "u00e9", '\\"', "0", '"}]', "id"], [f"x{i}" for i in range(1500)] + ["TV"]])
@pytest.mark.parametrize("gram", [1, 3, 5])
def test_any_list_of_names(spark, small, names, gram):
    listed = spark.createDataFrame([(n,) for n in names], "name string")
    want = {}
    for (n, _), c in brute(names).items():
        want[n] = want.get(n, 0) + c
    got = op.containment_counts(small, listed, "genres", gram=gram).collect()
    assert {r.name: r["count"] for r in got} == want


def test_containment_is_never_below_the_films_that_list_a_name(spark):
    films = load_films(spark, "/root/testdata/sf0.01")
    listed = {r.language: r["count"] for r in op.entry_counts(films, "spoken_languages", key="language").collect()}
    found = {r.language: r["count"] for r in op.counts_contains(films, "spoken_languages", "language").collect()}
    assert found.keys() == listed.keys() and all(found[n] >= listed[n] for n in listed)
    assert any(found[n] > listed[n] for n in listed)  # NATION_1 is in NATION_10


def test_names_meet_each_distinct_string_once(spark):
    """Texts made of few strings: grams are listed for the strings, not for
    the texts, and whole texts are listed only if a name has a quote."""
    rows = [(str(i), json.dumps([{"id": 1, "name": f"N{(i >> k) % 2}{k}"} for k in range(9)])) for i in range(512)]
    films = spark.createDataFrame(rows, "id string, genres string")
    listed = op.distinct_names(films)
    out = op.containment_counts(films, listed, "genres")
    assert {r["count"] for r in out.collect()} == {256} and out.count() == 18
    generated = _generated_rows(out)
    assert max(generated) <= 512 * 16  # the inverted table: 9 names and the text between
    assert sum(g > 100 for g in generated) <= 3  # names by entry, the table twice; no whole text
    with_quote = op.containment_counts(films, spark.createDataFrame([('"N00"',)], "name string"), "genres")
    assert [r["count"] for r in with_quote.collect()] == [256]


def _generated_rows(df):
    """Rows that each explode of the executed plan made."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Generate":
            found.append(node.metrics().get("numOutputRows").get().value())
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_building_the_query_runs_no_job(spark, small):
    group = "containment-is-lazy"
    spark.sparkContext.setJobGroup(group, group)
    op.genre_year_counts(small)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []


def test_missing_and_empty_dates_share_the_null_year_group(spark):
    rows = [("1", '[{"id": 1, "name": "Drama"}]', ""), ("2", '[{"id": 1, "name": "Drama"}]', None),
            ("3", '[{"id": 1, "name": "Drama"}]', "2009-13-40")]
    films = typed_films(spark.createDataFrame(rows, "id string, genres string, release_date string"))
    got = {(r.genre, r.release_year): r["count"] for r in op.genre_year_counts(films).collect()}
    assert got == {("Drama", None): 2, ("Drama", "2009"): 1}
