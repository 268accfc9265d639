"""Tables laid out for paging: sorted files, and a table of where each begins and ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators.ordinal import _not_after, with_ordinal

ROWS, BOUNDS = "rows", "bounds"


def write_pages(df: DataFrame, keys: list[str], path: str, rows_per_file: int) -> None:
    """Write ``df`` in the order of ``keys``, ``rows_per_file`` rows to each part, with its bounds.

    The order comes from one range shuffle (``with_ordinal``); ``keys`` should end in a unique column.
    """
    numbered = with_ordinal(df, keys).withColumn(
        "part", F.floor((F.col("ordinal") - 1) / rows_per_file).cast("bigint")
    )
    numbered.repartition("part").sortWithinPartitions("part", "ordinal").write.partitionBy(
        "part"
    ).parquet(f"{path}/{ROWS}")
    held = df.sparkSession.read.parquet(f"{path}/{ROWS}")
    key = F.struct(*keys)
    held.groupBy("part").agg(
        F.max_by(key, "ordinal").alias("last"),
        F.min("ordinal").alias("first_ordinal"),
        F.max("ordinal").alias("last_ordinal"),
    ).select("part", "last.*", "first_ordinal", "last_ordinal").write.parquet(f"{path}/{BOUNDS}")


def read_page(
    spark: SparkSession, path: str, keys: list[str], size: int, after: tuple | None = None
) -> DataFrame:
    """The ``size`` rows that follow the row with key values ``after``, with their ``ordinal``.

    The bounds name the parts that hold them, and only their files are opened; ``part`` tells which.
    There is no sort and no global limit, so a page may be as large as a reader likes.
    """
    bounds = spark.read.parquet(f"{path}/{BOUNDS}")
    rows = spark.read.parquet(f"{path}/{ROWS}")
    start = 0
    if after is not None:
        # the part that holds the row after which the page begins, or the first one beyond it
        reached = bounds.where(~_not_after(bounds, keys, after)).agg(F.min("part")).first()[0]
        if reached is None:
            return rows.where(F.lit(False))
        part = rows.where(F.col("part") == reached)
        before = part.where(_not_after(part, keys, after)).agg(F.max("ordinal")).first()[0]
        if before is None:
            before = part.agg(F.min("ordinal")).first()[0] - 1
        start = before
    needed = bounds.where(
        (F.col("last_ordinal") > start) & (F.col("first_ordinal") <= start + size)
    ).agg(F.min("part"), F.max("part")).first()
    if needed[0] is None:
        return rows.where(F.lit(False))
    return rows.where(
        F.col("part").between(needed[0], needed[1])
        & (F.col("ordinal") > start)
        & (F.col("ordinal") <= start + size)
    )
