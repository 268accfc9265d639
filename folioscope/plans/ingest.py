"""Raw records of both archives to rows of the document table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import schema as S
from folioscope.functions import dates as D
from folioscope.functions.lookup import convert_categories, provider
from folioscope.functions.records import author_names, subject_paths
from folioscope.functions.text import strip_newlines
from folioscope.operators.quality import split_rejects
from folioscope.sources.landed import CORRUPT

# Fixed value: the public address of an arXiv record.
ARXIV_URL = "https://arxiv.org/abs/"


# Where a record came from, carried to the rejects when the reader supplies it.
ORIGIN = (CORRUPT, "file")


def origin(raw: DataFrame) -> list[str]:
    return [c for c in ORIGIN if c in raw.columns]


def conform(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """All columns of the document table by name; absent and empty fields become null.

    ``keep`` names further columns to carry behind them.
    """
    columns = []
    for field in S.DOCUMENT:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            value = F.nullif(value, F.lit(""))
        elif isinstance(field.dataType, T.ArrayType):
            value = F.when(F.size(value) > 0, value)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns, *keep)


def normalise_arxiv(
    raw: DataFrame, stored: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """arXiv records: first and last version by position give the two dates."""
    first = F.try_element_at("versions", F.lit(1))["created"]
    last = F.try_element_at("versions", F.lit(-1))["created"]
    return conform(
        raw.select(
            F.concat(F.lit(ARXIV_URL), "id").alias("url"),
            F.lit("arXiv").alias("source"),
            F.col("id").alias("source_id"),
            D.http_date(first).alias("publish_date"),
            D.http_date(last).alias("modified_date"),
            (F.current_timestamp() if stored is None else stored).alias("stored_date"),
            strip_newlines(F.col("title")).alias("title"),
            strip_newlines(F.col("abstract")).alias("abstract"),
            F.array("authors").alias("authors"),
            convert_categories(F.split("categories", " ", -1)).alias("categories"),
            *keep,
        ),
        keep,
    )


def normalise_osf(
    raw: DataFrame, stored: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """OSF records: the provider's address names the source, subjects are two-level paths."""
    attributes = "data.attributes"
    published = D.published_or_created(
        F.col(f"{attributes}.date_published"), F.col(f"{attributes}.date_created")
    )
    return conform(
        raw.select(
            F.col("data.links.html").alias("url"),
            provider(F.col("data.relationships.provider.links.related.href")).alias("source"),
            F.col("data.id").alias("source_id"),
            D.iso_date(published).alias("publish_date"),
            D.iso_date(F.col(f"{attributes}.date_modified")).alias("modified_date"),
            (F.current_timestamp() if stored is None else stored).alias("stored_date"),
            F.col(f"{attributes}.title").alias("title"),
            F.col(f"{attributes}.description").alias("abstract"),
            author_names(F.col("data.embeds.contributors.data")).alias("authors"),
            subject_paths(F.col(f"{attributes}.subjects")).alias("categories"),
            *keep,
        ),
        keep,
    )


def ingest(
    raw: DataFrame, normalise: Callable[..., DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Documents and rejects of landed records; together they are all of them.

    A reject keeps the text of a line that did not parse, the file it came from, and the reason.
    """
    good, rejects = split_rejects(normalise(raw, keep=origin(raw)))
    return good.drop(*ORIGIN), rejects


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
