"""Incremental pulls as one streaming job over landed JSON lines."""

from __future__ import annotations

from collections.abc import Callable
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioscope.plans.ingest import ingest as judge
from folioscope.sources.landed import CORRUPT
from folioscope.sources.sinks import DOCUMENT_KEY, keyed_append

REJECTS = "_rejects"


def landed_stream(
    spark: SparkSession, path: str, ddl: str, max_files: int | None = None
) -> DataFrame:
    """Landed JSON lines; a line that does not parse keeps its text, every row its file."""
    reader = spark.readStream.schema(f"{ddl}, {CORRUPT} string").option(
        "columnNameOfCorruptRecord", CORRUPT
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).withColumn("file", F.col("_metadata.file_path"))


def oai_stream(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.readStream.format("xml").option("rowTag", "record").schema(ddl).load(path)


def ingest(
    landed: DataFrame,
    normalise: Callable[..., DataFrame],
    table: str,
    checkpoint: str,
    keys: tuple[str, ...] = DOCUMENT_KEY,
    stamp: str = "modified_date",
    partition: str | None = "source",
    rejects: str | None = REJECTS,
) -> StreamingQuery:
    """Append what has landed since the last run to ``table``, then stop.

    Each batch is judged as in ``plans.ingest.ingest``, and what is unfit is written to ``rejects``, one
    folder per batch, which a repeated batch overwrites; by default that is a hidden folder in the
    table. Without ``rejects``, or with a normaliser that cannot ``keep`` where a row came from, all
    rows are appended. The keyed append makes a repeated batch a no-op and removes repeats between
    pulls however far apart they are. De-duplication within a watermark is left out on purpose: it
    would drop records older than the watermark, and pulls do bring old records.
    """
    judged = rejects is not None and "keep" in signature(normalise).parameters
    unfit_path = f"{table}/{REJECTS}" if rejects == REJECTS else rejects

    def write(batch: DataFrame, batch_id: int) -> None:
        if judged:
            good, unfit = judge(batch, normalise)
            unfit.write.mode("overwrite").parquet(f"{unfit_path}/batch={batch_id}")
        else:
            good = normalise(batch)
        keyed_append(good, table, keys, stamp, partition)

    return (
        landed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
