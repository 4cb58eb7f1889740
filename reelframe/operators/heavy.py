"""Exact top-k of entry names without shuffling all names.

``top_k(entry_counts(...))`` moves every task's distinct names. Where these
are very many and few are common, this form moves bounded summaries first:

1. ``approx_top_k`` names candidates; counted exactly, the k-th of them is
   a floor under the k-th greatest count.
2. Every name falls into one bucket in each of two hashed tables; a bucket's
   total is an upper bound for each of its names, whatever the data.
3. Names with a bucket below the floor cannot be among the first k, nor tie
   with the last of them. The others are counted exactly and ranked.

The sketch decides how many names are left, never the result: a poor floor
(a flat distribution) leaves more names to count, all of them at worst,
which is the plain form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import exploded_name
from .frequency import top_k

BUCKETS = 1 << 14    # of each table: a task moves at most TABLES * BUCKETS partial sums
TABLES = 2
TRACKED = 10_000     # names that a task's sketch holds


def _bucket(table: int, key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(table), F.col(key)), F.lit(buckets)).cast("int")


def heavy_names(names: DataFrame, key: str, k: int, *, buckets: int = BUCKETS, tracked: int = TRACKED) -> DataFrame:
    """The rows of ``names`` whose ``key`` may be among the ``k`` most
    frequent, ties with the last included. A null key is a key like others."""
    sketch = names.filter(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {int(k)}, {max(int(tracked), int(k))})").alias("top"))
    # k rows at most.
    candidates = sketch.select(F.explode("top.item").alias(key))
    counted = names.join(F.broadcast(candidates), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    # With fewer than k candidates there is no floor.
    floor = counted.agg(F.when(F.count(F.lit(1)) >= k, F.min("n")).otherwise(F.lit(0)).alias("n")).scalar()
    places = F.explode(F.array(*(F.struct(F.lit(t).alias("t"), _bucket(t, key, buckets).alias("b")) for t in range(TABLES))))
    totals = names.select(places.alias("p")).groupBy("p.t", "p.b").agg(F.count(F.lit(1)).alias("n"))
    full = totals.filter(F.col("n") >= floor)
    for t in range(TABLES):
        # At most ``buckets`` rows of one number.
        mine = F.broadcast(full.filter(F.col("t") == t).select("b")).alias(f"t{t}")
        names = names.join(mine, _bucket(t, key, buckets) == F.col(f"t{t}.b"), "left_semi")
    return names


def heavy_top(films: DataFrame, column: str, k: int, *, key: str = "name", count: str = "count", drop_blank: bool = False,
              buckets: int = BUCKETS, tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent entry names of a JSON list column, ties broken
    on the name: equal to ``top_k(entry_counts(...), k, ...)``."""
    names = films.select(exploded_name(column, films=films).alias(key))
    if drop_blank:
        names = names.filter(F.col(key) != "")
    kept = heavy_names(names, key, k, buckets=buckets, tracked=tracked)
    return top_k(kept.groupBy(key).agg(F.count(F.lit(1)).alias(count)), k, key, count)
