"""Physical-plan properties: what runs where, and what never runs."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from reelframe import operators as op
from reelframe.catalog import ANALYSES, QUERIES
from reelframe.plans import count_nodes, formatted_plan, physical_plan, python_nodes
from reelframe.sources import films_from_tables, ingest_films, load_films


@pytest.fixture(scope="module")
def stored(spark):
    return ingest_films(films_from_tables(spark, SF_SMALL), "plan-test-films")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(spark, name):
    assert python_nodes(QUERIES[name](spark, SF_SMALL)) == []


def test_top_k_plans_take_ordered(stored):
    for df in (op.keyword_top(stored, 20), op.budget_top(stored), op.company_top(stored),
               op.language_top(stored)):
        assert "TakeOrderedAndProject" in physical_plan(df)


def test_counts_aggregate_partially_before_shuffle(stored):
    plan = physical_plan(op.genre_counts(stored))
    assert plan.count("HashAggregate") >= 2 and "partial_count" in plan


def test_point_tables_do_not_shuffle_and_push_filters(stored):
    df = op.budget_vs_rating(stored)
    plan = formatted_plan(df)
    assert "Exchange" not in physical_plan(df)
    assert "PushedFilters" in plan and "budget" in plan.split("PushedFilters")[1].splitlines()[0]


def test_scan_reads_only_needed_columns(stored):
    plan = formatted_plan(op.budget_top(stored))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert schemas and all("genres" not in s and "title" not in s for s in schemas)


def test_containment_is_an_equi_join(stored):
    plan = physical_plan(op.genre_counts_contains(stored))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "HashJoin" in plan or "SortMergeJoin" in plan


def test_shares_and_weights_need_no_window(stored):
    for df in (op.language_top_share(stored), op.keyword_weight(stored)):
        assert "Window" not in physical_plan(df)


@pytest.mark.parametrize("name, tables", [
    ("budget_top", {"orders"}), ("budget_vs_rating", {"orders", "lineitem"}), ("revenue_mean_by_year", {"orders", "lineitem"}),
    ("genre_counts", {"orders", "lineitem", "part"}), ("keyword_top", {"orders", "lineitem", "part"}),
    ("company_top", {"orders", "lineitem", "supplier"}), ("language_top", {"orders", "lineitem", "supplier", "nation"})])
def test_film_view_reads_only_the_tables_an_analysis_needs(spark, name, tables):
    spark.catalog.clearCache()  # a cached film view would stand in for the scans
    plan = formatted_plan(QUERIES[name](spark, SF_SMALL))
    scanned = {t for t in ("orders", "lineitem", "part", "supplier", "nation", "customer") if f"/{t}.parquet" in plan}
    assert scanned == tables


def test_year_range_reaches_the_scan_of_orders(spark):
    spark.catalog.clearCache()
    plan = formatted_plan(op.genre_share_by_year(load_films(spark, SF_SMALL), 1996, 2000))
    pushed = [x for x in plan.splitlines() if x.startswith("PushedFilters") and "o_orderdate" in x]
    assert pushed and all("1996-01-01" in x and "2001-01-01" in x for x in pushed)


def test_year_shares_broadcast_only_bounded_totals(stored):
    plan = physical_plan(op.genre_share_by_year(stored, 1996, 2000))
    assert "BroadcastHashJoin" in plan and "Window" not in plan


def test_grand_total_is_a_scalar_subquery(stored):
    plan = physical_plan(op.genre_share(stored))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_registered_queries_cover_analyses():
    assert set(QUERIES) - set(ANALYSES) == {"csv_roundtrip", "csv_blocks_roundtrip", "csv_lines_roundtrip", "json_sink_roundtrip",
                                            "json_array_roundtrip", "export_jobs_roundtrip", "export_jobs_resumed",
                                            "clustered_share_by_year", "genre_results_one_pass"}


def test_year_shares_scan_films_once(stored):
    df = op.genre_share_by_year(stored, 1996, 2000)
    df.collect()  # finalize the adaptive plan
    final = physical_plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_a_range_of_years_reaches_lineitem_below_the_aggregates(spark):
    """The range's order keys cut ``lineitem`` in a semi-join before anything
    is joined or grouped, and the rows are those of the filter alone."""
    plan = formatted_plan(QUERIES["genre_share_by_year"](spark, SF_SMALL))
    tree = plan.split("== Physical Plan ==")[1].split("\n\n")[0].splitlines()
    semi = [i for i, x in enumerate(tree) if "LeftSemi" in x or "Join" in x]
    assert "LeftSemi" in plan
    scans = [i for i, x in enumerate(tree) if "Scan parquet" in x]
    aggregates = [i for i, x in enumerate(tree) if "Aggregate" in x]
    assert semi and max(semi) < max(scans) and min(aggregates) < max(semi)  # a tree is printed from the top
    narrow = op.genre_share_by_year(load_films(spark, SF_SMALL, 1996, 2000), 1996, 2000).collect()
    assert narrow == op.genre_share_by_year(load_films(spark, SF_SMALL), 1996, 2000).collect() != []


def test_a_range_of_years_groups_only_its_lines(spark):
    """Rows that the lowest aggregate of list entries reads, with and without the range."""
    def grouped(years):
        df = load_films(spark, SF_SMALL, *years).filter("genres is not null").selectExpr("genres")
        df.collect()
        return _most_rows_into_aggregates(df)

    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").filter("year(o_orderdate) between 1996 and 1997")
    kept = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left_semi").count()
    assert grouped((None, None)) == lines.count() and grouped((1996, 1997)) == kept < lines.count() / 2


def _most_rows_into_aggregates(df):
    """The most rows that a join, which feeds an aggregate, made."""
    best, todo = 0, [(df._jdf.queryExecution().executedPlan(), False)]
    while todo:
        node, below = todo.pop()
        name = node.nodeName()
        if below and "Join" in name and "numOutputRows" in str(node.metrics().keySet()):
            best = max(best, node.metrics().get("numOutputRows").get().value())
            continue
        below = below or "Aggregate" in name
        if name == "AdaptiveSparkPlan":
            todo.append((node.executedPlan(), below))
        elif "QueryStage" in name:
            todo.append((node.plan(), below))
        children = node.children()
        todo += [(children.apply(k), below) for k in range(children.size())]
    return best
