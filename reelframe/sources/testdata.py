"""Film-shaped view over the driver's star-schema tables.

One film per order. The measures and each list column are separate
aggregates per order, left-joined to ``orders`` on the order key, which is
unique in each of them: Spark drops the joins whose columns an analysis does
not use, so point tables read ``orders`` and ``lineitem`` alone, genres and
keywords add only ``part``, companies only ``supplier`` and languages
``supplier`` and ``nation``. Orders without lines keep zeros and empty
arrays. The output has exactly the raw source layout (20 text columns, JSON
text for the list columns) and ``release_day`` as a date, so that a year
range reaches the scan of ``orders``.

Dimension joins are equi-joins that Spark broadcasts only when its size
statistics for that side fall under ``autoBroadcastJoinThreshold``
(otherwise sort-merge, with adaptive skew splitting).
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import RAW_COLUMNS

TABLES = ("orders", "lineitem", "part", "supplier", "nation")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c):
    return c.cast("string")


def _entries(lines: DataFrame, **entries) -> DataFrame:
    """Per order the distinct entries as JSON text, in a fixed order, so that
    a recomputed task yields the same text; null entries are left out."""
    key = F.col("l_orderkey").alias(f"{next(iter(entries))}_key")
    return lines.groupBy(key).agg(*[F.to_json(F.array_sort(F.collect_set(e))).alias(name) for name, e in entries.items()])


def films_from_tables(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None, *,
                      whole: bool = False) -> DataFrame:
    """Raw film rows of all orders, or of those of the years ``first..last``.

    ``whole`` is for callers that need every column: the lists of one
    dimension share an aggregate, so ``lineitem`` is joined with each
    dimension, sorted and shuffled once instead of once per list.

    With a range the keys of its orders reach ``lineitem`` in a semi-join
    below the aggregates, so only the range's lines are joined with the
    dimensions and grouped; the filter of an analysis alone stays above them.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    lines = read_table(spark, sf_dir, "lineitem")
    if first is not None or last is not None:
        day = F.col("o_orderdate").cast("date")
        if first is not None:
            orders = orders.filter(day >= F.lit(datetime.date(first, 1, 1)))
        if last is not None:
            orders = orders.filter(day <= F.lit(datetime.date(last, 12, 31)))
        keys = orders.select("o_orderkey")
        lines = lines.join(keys, lines.l_orderkey == keys.o_orderkey, "left_semi")
    part = read_table(spark, sf_dir, "part")
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")

    of_part = lines.join(part, lines.l_partkey == part.p_partkey)
    of_supplier = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
    of_nation = of_supplier.join(nation, of_supplier.s_nationkey == nation.n_nationkey)
    measures = lines.groupBy(F.col("l_orderkey").alias("measures_key")).agg(
        F.max("l_tax").alias("popularity"),
        F.round(F.max("l_discount") * 100, 1).alias("vote_average"),
        F.sum("l_quantity").cast("bigint").alias("vote_count"),
        F.floor(F.sum(F.col("l_extendedprice").cast("decimal(12,2)"))).cast("bigint").alias("revenue"),
        F.max("l_quantity").cast("bigint").alias("runtime"))
    entry = {
        "genres": F.struct(F.length("p_type").alias("id"), F.col("p_type").alias("name")),
        "keywords": F.struct(F.col("l_partkey").alias("id"), F.col("p_name").alias("name")),
        "production_companies": F.struct(F.col("s_name").alias("name"), F.col("l_suppkey").alias("id")),
        "spoken_languages": F.struct(_text(F.col("n_nationkey")).alias("iso_639_1"), F.col("n_name").alias("name")),
    }
    if whole:
        of_supplier = of_supplier.join(nation, of_supplier.s_nationkey == nation.n_nationkey, "left")
        entry["spoken_languages"] = F.when(F.col("n_nationkey").isNotNull(), entry["spoken_languages"])
        sources = [(of_part, ["genres", "keywords"]), (of_supplier, ["production_companies", "spoken_languages"])]
    else:
        sources = [(of_part, ["genres"]), (of_part, ["keywords"]), (of_supplier, ["production_companies"]),
                   (of_nation, ["spoken_languages"])]

    films = orders.join(measures, orders.o_orderkey == measures.measures_key, "left")
    for source, names in sources:
        entries = _entries(source, **{name: entry[name] for name in names})
        films = films.join(entries, films.o_orderkey == entries[f"{names[0]}_key"], "left")
    empty = F.lit("[]")
    zero = F.lit(0)
    out = {
        "budget": _text((F.floor(F.col("o_totalprice") / 10000) * 10000).cast("bigint")),
        "genres": F.coalesce("genres", empty),
        "homepage": F.lit(None).cast("string"),
        "id": _text(F.col("o_orderkey")),
        "keywords": F.coalesce("keywords", empty),
        "original_language": F.lit(None).cast("string"),
        "original_title": F.concat(F.lit("Order#"), _text(F.col("o_orderkey"))),
        "overview": F.col("o_orderpriority"),
        "popularity": _text(F.coalesce(F.col("popularity"), F.lit(0.0))),
        "production_companies": F.coalesce("production_companies", empty),
        "production_countries": empty,
        "release_date": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "revenue": _text(F.coalesce(F.col("revenue"), zero.cast("bigint"))),
        "runtime": _text(F.coalesce(F.col("runtime"), zero.cast("bigint"))),
        "spoken_languages": F.coalesce("spoken_languages", empty),
        "status": F.col("o_orderstatus"),
        "tagline": F.lit(None).cast("string"),
        "title": F.concat(F.lit("Order#"), _text(F.col("o_orderkey"))),
        "vote_average": _text(F.coalesce(F.col("vote_average"), F.lit(0.0))),
        "vote_count": _text(F.coalesce(F.col("vote_count"), zero.cast("bigint"))),
    }
    return films.select(*[out[c].alias(c) for c in RAW_COLUMNS], F.col("o_orderdate").cast("date").alias("release_day"))
