"""Readers of landed archive records; every one takes an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope import schema as S
from folioscope.functions.text import strip_newlines

CORRUPT = "_corrupt_record"


def read_json_lines(
    spark: SparkSession, paths: str | list[str], ddl: str, with_file: bool = False
) -> DataFrame:
    """One JSON object per line; a line that does not parse keeps its text in ``_corrupt_record``."""
    rows = (
        spark.read.schema(f"{ddl}, {CORRUPT} string")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(paths)
    )
    return rows.withColumn("file", F.col("_metadata.file_path")) if with_file else rows


def read_arxiv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_json_lines(spark, paths, S.ARXIV_RECORD, with_file=True)


def read_osf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Landed OSF records of all files a path or glob names, with the file each came from."""
    return read_json_lines(spark, paths, S.OSF_RECORD, with_file=True)


def file_rank(path: Column) -> Column:
    """Sort key of a landed file or folder: ranges without a start date first, others by name.

    The last part of the path that is named like a pull counts, whatever the folders above it.
    """
    name = F.regexp_extract(path, r".*(?<![^/=])(osf-[^/]*)", 1)
    return F.when(F.contains(name, F.lit("beginning")), F.lit("osf-00")).otherwise(name)


def read_oai_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all landed OAI-PMH pages."""
    return (
        spark.read.format("xml")
        .option("rowTag", "record")
        .option("ignoreSurroundingSpaces", "false")
        .schema(S.OAI_RECORD)
        .load(path)
    )


def read_oai_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The resumption tokens of all landed OAI-PMH pages."""
    return spark.read.format("xml").option("rowTag", "resumptionToken").schema(S.OAI_TOKEN).load(path)


def oai_ids(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("metadata.arXiv.id").alias("id"),
        strip_newlines(F.col("metadata.arXiv.title")).alias("title"),
    )


def parse_list_pages(pages: DataFrame, body: str = "value") -> DataFrame:
    """Landed OSF list pages from their JSON text; other columns are kept."""
    return pages.withColumn("page", F.from_json(body, S.OSF_LIST_PAGE)).drop(body)


def page_links(pages: DataFrame, order: str) -> DataFrame:
    """``(order, pos, link)``: the record addresses of each page, in page order."""
    return pages.select(order, F.posexplode("page.data").alias("pos", "d")).select(
        order, F.col("pos").cast("bigint").alias("pos"), F.col("d.links.self").alias("link")
    )
