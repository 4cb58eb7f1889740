"""SQL-text forms leave the views of a session alone."""

from __future__ import annotations

from reelframe import operators as op


def test_two_tables_and_a_view_of_the_same_name(spark):
    schema = "runtime int, genres string"
    one = spark.createDataFrame([(90, '[{"name": "a"}]')] * 3, schema)
    two = spark.createDataFrame([(120, '[{"name": "b"}]')] * 2, schema)
    spark.range(7).createOrReplaceTempView("films")
    before = {t.name for t in spark.catalog.listTables()}
    first, second = op.entry_counts_sql(one), op.entry_counts_sql(two)
    assert [tuple(r) for r in first.collect()] == [("a", 3)] and [tuple(r) for r in second.collect()] == [("b", 2)]
    assert [tuple(r) for r in op.runtime_common_sql(one, 2).collect()] == [(90, 3)]
    assert {t.name for t in spark.catalog.listTables()} == before and spark.table("films").count() == 7
    op.runtime_common_sql(two, 1, view="kept")
    assert spark.table("kept").count() == 2
    spark.catalog.dropTempView("kept")
    spark.catalog.dropTempView("films")
