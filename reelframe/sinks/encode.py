"""Result encodings as columns.

Single-document encodings gather rows into one value, so they are only for
bounded results: the input is cut to ``bound + 1`` rows before it is
gathered, and a result with more than ``bound`` rows fails with an error
instead of being silently truncated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import delimited

NULLS = {"ignoreNullFields": "false"}


def json_object(columns: Sequence[str]) -> Column:
    """The row's JSON object text; null fields are written as null."""
    return F.to_json(F.struct(*columns), NULLS)


def json_array(columns: Sequence[str]) -> Column:
    """The row's JSON array text, ``["title", 1, 2.5]``."""
    def value(c: str) -> Column:
        one = F.to_json(F.array(F.col(c)), NULLS)
        return F.substring(one, 2, F.length(one) - 2)

    return F.concat(F.lit("["), F.concat_ws(",", *(value(c) for c in columns)), F.lit("]"))


def json_lines(df: DataFrame, column: str = "json") -> DataFrame:
    """One JSON object text per row; null fields are written as null."""
    return df.select(json_object(df.columns).alias(column))


def array_lines(df: DataFrame, column: str = "json") -> DataFrame:
    """One JSON array text per row."""
    return df.select(json_array(df.columns).alias(column))


def _comparator(keys: Sequence[str], descending: Sequence[bool]):
    def cmp(left: Column, right: Column) -> Column:
        out = F.lit(0)
        for key, desc in reversed(list(zip(keys, descending))):
            a, b = left[key], right[key]
            lt, gt = (F.lit(1), F.lit(-1)) if desc else (F.lit(-1), F.lit(1))
            out = F.when(a < b, lt).when(a > b, gt).otherwise(out)
        return out
    return cmp


def _gathered(df: DataFrame, bound: int) -> Column:
    rows = F.collect_list(F.struct(*df.columns))
    return F.when(F.count(F.lit(1)) <= bound, rows).otherwise(
        F.raise_error(F.lit(f"result has more than {bound} rows; write it as an array of part files or as JSON lines")))


def json_document(df: DataFrame, bound: int, *, order: Sequence[str] = (),
                  descending: Sequence[bool] | None = None, column: str = "document") -> DataFrame:
    """The whole (bounded) result as one JSON array text, in ``order``."""
    desc = list(descending) if descending is not None else [False] * len(order)
    rows = df.limit(bound + 1).agg(_gathered(df, bound).alias("_rows"))
    arr = F.col("_rows")
    if order:
        arr = F.array_sort(arr, _comparator(order, desc))
    return rows.select(F.to_json(arr, NULLS).alias(column))


def parallel_arrays(df: DataFrame, key: str, value: str, bound: int) -> DataFrame:
    """A keys array and a values array, both in key order, as JSON texts.
    ``bound`` follows from how ``df`` was made: a k, or a range of years."""
    rows = df.select(key, value).limit(bound + 1).agg(
        _gathered(df.select(key, value), bound).alias("_rows"))
    ordered = F.array_sort("_rows")
    return rows.select(F.to_json(ordered.getField(key)).alias("keys"),
                       F.to_json(ordered.getField(value)).alias("values"))


def console_lines(df: DataFrame, *cols: str, sep: str = ",", end: str = "&") -> DataFrame:
    """``a,b,c&`` per row (missing values print as ``null``)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]
    return df.select(delimited(*parts, sep=sep, end=end).alias("line"))
