"""Global order: ordinals, positional split, batches and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.session import stable

STEPS = 16
_ROW_BITS = 33  # monotonically_increasing_id: partition in the high bits, row in the low 33


def order_columns(keys: list[str]) -> list[Column]:
    return [F.asc_nulls_last(k) for k in keys]


def with_ordinal(
    df: DataFrame, keys: list[str], name: str = "ordinal", partitions: int | None = None
) -> DataFrame:
    """Number all rows 1..n in the order of ``keys``, without one task seeing all of them.

    One range shuffle sorts the table; the sorted partitions are written to the shared folder,
    counted, and the running totals of the counts (one row per partition) turn a row's place in
    its partition into its place in the table. ``keys`` should end in a unique column: that makes
    the order total, and lets the range partitioning split a date that holds many rows.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stable(
        df.repartitionByRange(n, *order_columns(keys))
        .sortWithinPartitions(*order_columns(keys))
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    # offsets holds one row per shuffle partition, whatever the size of the table
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + row + 1).cast("bigint"))
        .drop("_part", "_place", "_offset")
    )


def split_point(total: int, test_share: float) -> int:
    return total - int(total * test_share)


def _bound(df: DataFrame, key: str, value: object) -> Column:
    """A key value as a literal of the column's own type, so that the scan can use the comparison."""
    return F.lit(value).cast(df.schema[key].dataType)


def _not_after(df: DataFrame, keys: list[str], bound: tuple) -> Column:
    """``keys <= bound`` in the order of ``order_columns`` (nulls last)."""
    verdict = F.lit(True)
    for key, value in reversed(list(zip(keys, bound))):
        column = F.col(key)
        if value is None:
            verdict = column.isNotNull() | verdict
        else:
            limit = _bound(df, key, value)
            before = F.coalesce(column < limit, F.lit(False))
            verdict = before | (column.eqNullSafe(limit) & verdict)
    return verdict


def split_by_position(
    df: DataFrame, keys: list[str], test_share: float = 0.1, name: str = "split"
) -> DataFrame:
    """Mark each row ``train`` or ``test``: the last ``test_share`` of the order is the test set.

    Only the key columns are sorted. The key of the last training row then becomes a predicate,
    so the documents themselves are neither shuffled nor joined.
    """
    numbered = with_ordinal(df.select(*keys), keys)
    cut = split_point(numbered.count(), test_share)
    # as text, because a timestamp would pass through the time zone of the Python process
    row = numbered.where(F.col("ordinal") == cut).select(*[F.col(k).cast("string") for k in keys])
    last_train = row.first()
    in_train = F.lit(False) if last_train is None else _not_after(df, keys, tuple(last_train))
    return df.withColumn(name, F.when(in_train, F.lit("train")).otherwise(F.lit("test")))


def assign_batches(df: DataFrame, keys: list[str], size: int, name: str = "batch") -> DataFrame:
    """Consecutive batches of ``size`` rows, numbered from 0; the last one may be short."""
    numbered = with_ordinal(df, keys)
    return numbered.withColumn(name, F.floor((F.col("ordinal") - 1) / size).cast("bigint"))


def first_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of the order (a result cap)."""
    return df.orderBy(*order_columns(keys)).limit(n)


def highest(df: DataFrame, amount: str, tie: str, n: int) -> DataFrame:
    """The ``n`` rows of the largest ``amount``, equal ones by ``tie``, without gathering them in a task.

    ``amount`` is a number above zero. A histogram over ``STEPS`` steps to each doubling, a few hundred rows
    whatever the table, tells which step the last row falls in. Rows above it are kept as they are,
    and only those of that step are put in order, by a range shuffle.
    """
    placed = stable(df.withColumn("_step", F.floor(F.log2(F.col(amount).cast("double")) * STEPS)))
    held, edge, left = 0, None, n
    for row in placed.groupBy("_step").count().orderBy(F.desc("_step")).collect():
        if held + row["count"] > n:
            edge, left = row["_step"], n - held
            break
        held += row["count"]
    if edge is None:
        return placed.drop("_step")
    above = placed.where(F.col("_step") > edge).drop("_step")
    if left == 0:
        return above
    step = placed.where(F.col("_step") == edge).withColumn("_falling", -F.col(amount))
    last = with_ordinal(step, ["_falling", tie], "_at").where(F.col("_at") <= left)
    return above.unionByName(last.drop("_step", "_falling", "_at"))


def page_after(
    df: DataFrame, keys: list[str], size: int, after: tuple | None = None
) -> DataFrame:
    """The ``size`` rows that follow the row with key values ``after``; the first page without.

    Nulls come last, as everywhere here. Comparing the leading key on its own lets the scan skip
    what earlier pages showed.
    """
    page = df
    if after is not None:
        first = F.col(keys[0])
        # rows before the leading key's bound are out, whatever the other keys are
        reachable = first.isNull()
        if after[0] is not None:
            reachable = reachable | (first >= _bound(df, keys[0], after[0]))
        page = df.where(reachable & ~_not_after(df, keys, after))
    return page.orderBy(*order_columns(keys)).limit(size)
