"""Writers: document table, landing zone, fitted model, test set and report."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope import schema as S
from folioscope.session import broadcast_if_small, fits_broadcast, stable

DOCUMENT_KEY = ("source", "source_id")
LOAD_TIME = "stored_date"  # differs between loads of one version
# A table's own records lie in hidden folders inside of it, which its readers pass over.
LEDGER, COMMITS = "_ledger", "_commits"
LEDGER_BUCKETS = 16


def create_document_table(spark: SparkSession, name: str = "documents", path: str | None = None):
    """Create the document table unless it exists."""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in S.DOCUMENT
    )
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (source){location}"
    )


def append(df: DataFrame, path: str, partition: str | None = "source") -> None:
    """Add all rows; a rerun adds them again."""
    if partition is None:
        df.write.mode("append").parquet(path)
        return
    # rebalance merges small and splits large partitions, so a source that holds most rows is
    # written by many tasks and a small one by few
    df.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(path)


def _identity(df: DataFrame, keys: tuple[str, ...], ignore: tuple[str, ...] = ()) -> list[Column]:
    """The key columns, and the content of a row in place of a key that has a null.

    Rows without a full key cannot be told to be versions of each other, so only equal ones meet.
    """
    nameless = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    content = F.sha2(F.to_json(F.struct(*sorted(set(df.columns) - set(ignore)))), 256)
    return [*[F.col(k).alias(f"_{k}") for k in keys], F.when(nameless, content).alias("_content")]


def newest(
    df: DataFrame, keys: tuple[str, ...] = DOCUMENT_KEY, stamp: str = "modified_date"
) -> DataFrame:
    """The latest version of each key, pre-aggregated before the shuffle.

    Of versions with an equal stamp the one stored last counts.
    """
    row = F.struct(*df.columns)
    order = [stamp, *[c for c in (LOAD_TIME,) if c in df.columns]]
    return (
        df.groupBy(*_identity(df, keys, (LOAD_TIME,)))
        .agg(F.max_by(row, F.struct(*order, row)).alias("row"))
        .select("row.*")
    )


def _existing(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``, or None; the schema is given because values of a partition column would
    be guessed otherwise."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class Ledger:
    """What versions a table holds, without the table: keys, stamp and a hash of the content.

    Rows are dealt to buckets by key, one folder each, so a batch reads only the buckets it touches
    and none of the table. They are written before the table and name their batch; the batch is
    confirmed after the table has it. Rows of a batch that was never confirmed prove nothing, so
    these versions are looked up in the table itself.
    """

    def __init__(self, path: str, schema, version: tuple[str, ...], buckets: int):
        self.path, self.version = path, version
        self.names = [*[f"_{c}" for c in version], "_content"]
        self.content = sorted(set(schema.names) - set(version) - {LOAD_TIME})
        kinds = [f"`_{c}` {schema[c].dataType.simpleString()}" for c in version]
        self.schema = ", ".join([*kinds, "_content bigint", "batch string", "ledger_bucket int"])
        self.bucket = F.pmod(F.xxhash64(*[f"_{c}" for c in version[:-1]]), F.lit(buckets)).cast("int")

    def tagged(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the columns that tell versions apart."""
        content = F.xxhash64(F.lit(len(self.content)), *self.content)
        return rows.select(
            "*", *[F.col(c).alias(f"_{c}") for c in self.version], content.alias("_content")
        )

    def same(self, a: DataFrame, b: DataFrame) -> Column:
        return reduce(Column.__and__, [a[c].eqNullSafe(b[c]) for c in self.names])

    def touched(self, held: DataFrame, asked: DataFrame) -> DataFrame:
        """The rows of the buckets, at most as many as the ledger has, that hold the keys asked for."""
        buckets = [r[0] for r in asked.select(self.bucket).distinct().collect()]
        return held.where(F.col("ledger_bucket").isin(buckets))

    def within(self, rows: DataFrame, asked: DataFrame) -> DataFrame:
        """The versions of ``rows`` that are asked for, once each."""
        rows = rows.select(self.names)
        return rows.join(asked, self.same(rows, asked), "left_semi").distinct()

    def enter(self, versions: DataFrame, batch: str) -> None:
        rows = versions.select(*self.names, F.lit(batch).alias("batch"), self.bucket.alias("ledger_bucket"))
        # one file a bucket and batch; a large bucket is split
        rows.hint("rebalance", "ledger_bucket").write.mode("append").partitionBy("ledger_bucket").parquet(
            f"{self.path}/{LEDGER}"
        )

    def confirm(self, spark: SparkSession, batch: str) -> None:
        row = spark.range(1, numPartitions=1).select(F.lit(batch).alias("batch"))
        row.write.mode("append").parquet(f"{self.path}/{COMMITS}")

    def holds(self, asked: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Of the versions asked for those the table holds, and of them those to be entered again."""
        spark = asked.sparkSession
        held = _existing(spark, f"{self.path}/{LEDGER}", self.schema)
        if held is None:
            # a table from before it had a ledger
            batch = uuid.uuid4().hex
            self.enter(self.tagged(table).select(self.names).distinct(), batch)
            self.confirm(spark, batch)
            held = spark.read.schema(self.schema).parquet(f"{self.path}/{LEDGER}")
        rows = self.touched(held, asked)
        commits = _existing(spark, f"{self.path}/{COMMITS}", "batch string")
        if commits is None:
            commits = spark.createDataFrame([], "batch string")
        confirmed = commits.select(F.col("batch").alias("known")).distinct()
        found = stable(
            rows.join(asked, self.same(rows, asked), "left_semi")
            .join(confirmed, F.col("batch") == F.col("known"), "left")
            .groupBy(self.names)
            .agg(F.max(F.col("known").isNotNull()).alias("sure"))
        )
        sure = found.where("sure").drop("sure")
        doubtful = found.where("NOT sure").drop("sure")
        if doubtful.isEmpty():
            return sure, None
        present = stable(self.within(self.tagged(table), broadcast_if_small(doubtful)))
        return sure.unionByName(present), present


def keyed_append(
    df: DataFrame,
    path: str,
    keys: tuple[str, ...] = DOCUMENT_KEY,
    stamp: str = "modified_date",
    partition: str | None = "source",
    buckets: int = LEDGER_BUCKETS,
) -> None:
    """Add the versions the table does not hold yet: a version is a key, a ``stamp`` and a content.

    Running the same batch again adds nothing, so a retried batch is harmless; a changed record adds
    a version, also under an equal stamp, and readers take ``newest``. Keys, stamps and contents
    compare null-safe; the load time is no content. What is held is read from the ledger of the
    table, and of that only the buckets the batch touches. ``buckets`` must stay the same for a table.
    """
    spark = df.sparkSession
    ledger = Ledger(path, df.schema, (*keys, stamp), buckets)
    row = F.struct(*df.columns)
    fresh = stable(
        ledger.tagged(df)
        .groupBy(ledger.names)
        .agg(F.max(row).alias("row"))
        .select("row.*", *ledger.names)
    )
    table, again = _existing(spark, path, df.schema), None
    if table is not None:
        asked = fresh.select(ledger.names)
        if fits_broadcast(asked):
            asked = F.broadcast(asked)
        known, again = ledger.holds(asked, table)
        fresh = fresh.join(known, ledger.same(fresh, known), "left_anti")
    batch = uuid.uuid4().hex
    new = fresh.select(ledger.names)
    ledger.enter(new if again is None else new.unionByName(again), batch)
    append(fresh.select(df.columns), path, partition)
    ledger.confirm(spark, batch)


def insert(df: DataFrame, name: str) -> None:
    """Append to a created table by its name, columns matched by name."""
    df.select(df.sparkSession.table(name).columns).write.insertInto(name)


def land_payload(df: DataFrame, path: str, date: Column | None = None) -> None:
    """Keep raw API payloads as JSON lines, one folder per ingest date."""
    day = F.current_date() if date is None else date
    df.withColumn("ingest_date", day).write.mode("append").partitionBy("ingest_date").json(path)


def save_model(model: DataFrame, path: str) -> None:
    model.write.mode("errorifexists").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_test_set(docs: DataFrame, vectors: DataFrame, path: str) -> None:
    """The documents and their vectors; documents without any known term are in the former only."""
    docs.write.mode("errorifexists").parquet(f"{path}/documents")
    vectors.write.mode("errorifexists").parquet(f"{path}/vectors")


def load_test_set(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/documents"), spark.read.parquet(f"{path}/vectors")


def report_line(score: Column, n: Column, category: Column) -> Column:
    """``score <tab> n <tab> category``; a missing score prints as `` nan``, four wide."""
    return F.concat_ws(
        "\t",
        F.when(score.isNull() | F.isnan(score), F.lit(" nan")).otherwise(
            F.format_string("%4f", score)
        ),
        F.format_string("%d", n),
        category,
    )


def write_report(report: DataFrame, path: str) -> None:
    """The report as text, categories by name and the random baseline last."""
    report.orderBy(F.col("kind") == "random", "category").select(
        report_line(F.col("avg_cos"), F.col("n"), F.col("category")).alias("value")
    ).write.mode("errorifexists").text(path)
