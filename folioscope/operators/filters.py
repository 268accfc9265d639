"""Row predicates; each compares the raw column so that the scan can use it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def created_between(
    df: DataFrame, column: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Rows of the days ``start`` to ``end``, both included; either end may be left open."""
    stamp = df.schema[column].dataType.simpleString()
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start.isoformat()).cast(stamp))
    if end is not None:
        day_after = end + dt.timedelta(days=1)
        df = df.where(F.col(column) < F.lit(day_after.isoformat()).cast(stamp))
    return df


def modified_since(df: DataFrame, column: str, since: dt.date | dt.datetime) -> DataFrame:
    stamp = df.schema[column].dataType.simpleString()
    return df.where(F.col(column) >= F.lit(since.isoformat()).cast(stamp))
