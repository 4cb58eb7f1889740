"""Text shaping columns used by result shapes and sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def suffixed(c: Column, suffix: str) -> Column:
    return F.concat(c.cast("string"), F.lit(suffix))


def unpadded_date(c: Column) -> Column:
    """``Y-M-D`` without zero padding, e.g. ``1996-1-5``."""
    return F.date_format(c, "y-M-d")


def delimited(*cols: Column, sep: str = ",", end: str = "") -> Column:
    """One text line from several columns (console-line sink shape)."""
    line = F.concat_ws(sep, *[c.cast("string") for c in cols])
    return F.concat(line, F.lit(end)) if end else line
