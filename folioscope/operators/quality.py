"""Audits of what was landed: duplicate keys, page completeness, required fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.vectors import has_dims
from folioscope.schema import DOC_VECTOR_DIMS
from folioscope.sources.landed import CORRUPT


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """One row: ``n_unique`` ids and ``n_dupes`` rows beyond the first of their id."""
    per_id = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_id.agg(
        F.count("*").alias("n_unique"), F.sum(F.col("n") - 1).cast("bigint").alias("n_dupes")
    )


def page_count(total: Column, per_page: Column) -> Column:
    return F.ceil(total / per_page).cast("bigint")


def page_audit(records: DataFrame, tokens: DataFrame) -> DataFrame:
    """One row: records landed against the list size that the resumption tokens announce.

    A complete list without a token (a single page) announces nothing and counts as complete.
    """
    landed = records.agg(F.count("*").alias("n_records"))
    announced = tokens.agg(
        F.count("*").alias("n_tokens"),
        F.max("_completeListSize").alias("list_size"),
        F.max("_cursor").alias("last_cursor"),
    )
    sizes = announced.select(F.struct("n_tokens", "list_size", "last_cursor").alias("a"))
    return landed.withColumn("a", sizes.scalar()).select(
        "n_records",
        "a.*",
        F.coalesce(F.col("n_records") == F.col("a.list_size"), F.lit(True)).alias("complete"),
    )


def cursor_ranges(
    pages: DataFrame, cursor: str, n: str, total: str, by: list[str] | None = None
) -> DataFrame:
    """``(by, kind, start, stop, times)``: where landed pages leave gaps or meet, ``stop`` excluded.

    A page covers ``n`` positions from its ``cursor`` in a list of ``total`` positions. Ranges that no page
    covers are ``missing``, those of several are ``doubled``, and what lies behind the announced end is
    ``beyond``; neighbouring ranges of one kind and number of pages are one. A page landed twice
    therefore hides no lost one. ``by`` tells lists apart; the pages of one list meet in one window.
    """
    by = by or []
    listed = pages.select(*by, F.col(cursor).alias("a"), F.col(n).alias("n"), F.col(total).alias("total"))
    announced = F.max("total").over(Window.partitionBy(*by))
    listed = listed.withColumn("total", announced).withColumn("b", F.col("a") + F.col("n"))
    # each page opens a position and closes one; the ends of the list are marked without weight
    steps = F.array(*[
        F.struct(at.cast("bigint").alias("at"), F.lit(weight).alias("weight"), F.lit(mark).alias("mark"))
        for at, weight, mark in (
            (F.col("a"), 1, False),
            (F.col("b"), -1, False),
            (F.lit(0), 0, True),
            (F.col("total"), 0, True),
        )
    ])
    changes = (
        listed.select(*by, "total", F.explode(steps).alias("s"))
        .groupBy(*by, "total", "s.at")
        .agg(F.sum("s.weight").alias("weight"), F.max("s.mark").alias("mark"))
        .where((F.col("weight") != 0) | F.col("mark"))
    )
    order = Window.partitionBy(*by).orderBy("at")
    ranges = changes.select(
        *by,
        "total",
        F.col("at").alias("start"),
        F.lead("at").over(order).alias("stop"),
        F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("times"),
    )
    inside = F.col("start") < F.col("total")
    kind = (
        F.when(~inside, F.when(F.col("times") > 0, "beyond"))
        .when(F.col("times") == 0, "missing")
        .when(F.col("times") > 1, "doubled")
    )
    return (
        ranges.withColumn("kind", kind)
        .where(F.col("kind").isNotNull() & F.col("stop").isNotNull())
        .select(*by, "kind", "start", "stop", F.col("times").cast("bigint").alias("times"))
    )


def list_audit(pages: DataFrame, links: DataFrame, landed: DataFrame, link: str = "link"):
    """One row on a pull by list pages: what ``meta`` announces against pages, links and records.

    ``pages`` has the parsed ``page``; ``links`` and ``landed`` have one address per row. Also see
    ``missing_records``.
    """
    meta = pages.agg(
        F.count("*").alias("n_pages"),
        F.max("page.meta.total").alias("total"),
        F.max(page_count(F.col("page.meta.total"), F.col("page.meta.per_page"))).alias("announced_pages"),
    )
    listed = links.agg(F.count_distinct(link).alias("n_links")).scalar()
    absent = missing_records(links, landed, link).agg(F.count("*")).scalar()
    return meta.select("*", listed.alias("n_links"), absent.alias("n_missing")).withColumn(
        "complete",
        (F.col("n_pages") == F.col("announced_pages"))
        & (F.col("n_links") == F.col("total"))
        & (F.col("n_missing") == 0),
    )


def missing_records(links: DataFrame, landed: DataFrame, link: str = "link") -> DataFrame:
    """Listed addresses without a landed record."""
    return links.select(link).distinct().join(landed.select(link).distinct(), link, "left_anti")


def split_rejects(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows fit for the document table, and the rest with a reason each."""
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in docs.columns else F.lit(False)
    reason = (
        F.when(corrupt, F.lit("unreadable line"))
        .when(F.col("source").isNull(), F.lit("no source"))
        .when(F.col("url").isNull(), F.lit("no url"))
        .when(F.col("publish_date").isNull(), F.lit("no readable publish date"))
        .when(F.col("modified_date").isNull(), F.lit("no readable modified date"))
        .when(
            F.col("doc_vector").isNotNull() & ~has_dims(F.col("doc_vector"), DOC_VECTOR_DIMS),
            F.lit(f"vector is not of length {DOC_VECTOR_DIMS}"),
        )
    )
    judged = docs.withColumn("reject_reason", reason)
    return (
        judged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
        judged.where(F.col("reject_reason").isNotNull()),
    )
