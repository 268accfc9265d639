"""Where the last pull of each source stopped.

A mark is the latest stamp of a source that the table holds for certain. It is advanced only after
the append is confirmed, so a run that fails in between pulls the same changes again and the ledger
of the table keeps them from being stored twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.session import broadcast_if_small, stable
from folioscope.sources.sinks import DOCUMENT_KEY, _existing, keyed_append

MARKS = "_marks"


def high_water(df: DataFrame, path: str, by: str = "source", stamp: str = "modified_date") -> DataFrame:
    """``(by, mark)`` of the table at ``path`` for sources like those of ``df``; empty at first."""
    kinds = [f"`{by}` {df.schema[by].dataType.simpleString()}"]
    kinds.append(f"mark {df.schema[stamp].dataType.simpleString()}")
    held = _existing(df.sparkSession, f"{path}/{MARKS}", ", ".join(kinds))
    if held is None:
        held = df.sparkSession.createDataFrame([], ", ".join(kinds))
    return held.groupBy(by).agg(F.max("mark").alias("mark"))


def changed_since(
    feed: DataFrame, marks: DataFrame, by: str = "source", stamp: str = "modified_date"
) -> DataFrame:
    """Rows of ``feed`` from the mark of their source on; all rows of a source without one.

    The instant of the mark is pulled again, because a change of the same instant may have come
    after it. Rows without a stamp are always pulled.
    """
    marks = broadcast_if_small(marks.select(F.col(by).alias("_by"), "mark"))
    due = F.col("mark").isNull() | F.col(stamp).isNull() | (F.col(stamp) >= F.col("mark"))
    return feed.join(marks, F.col(by).eqNullSafe(F.col("_by")), "left").where(due).drop("_by", "mark")


def advance(pulled: DataFrame, path: str, by: str = "source", stamp: str = "modified_date") -> None:
    """Raise the marks to the latest stamps of what was appended."""
    reached = pulled.where(F.col(stamp).isNotNull()).groupBy(by).agg(F.max(stamp).alias("mark"))
    reached.write.mode("append").parquet(f"{path}/{MARKS}")


def pull(
    feed: DataFrame,
    path: str,
    keys: tuple[str, ...] = DOCUMENT_KEY,
    stamp: str = "modified_date",
    by: str = "source",
) -> DataFrame:
    """Append what has changed since the last pull, then advance the marks; gives what was pulled."""
    pulled = stable(changed_since(feed, high_water(feed, path, by, stamp), by, stamp))
    keyed_append(pulled, path, keys, stamp, by)
    advance(pulled, path, by, stamp)
    return pulled
