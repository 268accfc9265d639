"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table of at most this many rows and bytes is broadcast outright; beyond either the join
# strategy is left to the sizes Spark measures.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def build_session(app: str = "folioscope", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this package relies on; size settings stay with the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates are naive UTC throughout, so pin the zone before anything parses one."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="folioscope-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stable(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder, so that later passes see the same rows.

    Used where two passes must agree (global ordinals) or where one result feeds several
    branches. Nothing is recomputed when executors are lost, and later passes read only the
    columns they need. The folder is the cluster's to clear.
    """
    path = scratch_path(df.sparkSession, "stable")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compact(df: DataFrame) -> DataFrame:
    """``stable`` for tables of terms and vectors, about a third smaller than with Spark's default."""
    return stable(df, "zstd")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the counted rows and bytes of a table allow a broadcast.

    Numbers count eight bytes, texts their length, nested values that of their JSON form.
    """

    def width(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0))
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
        return F.lit(8)

    widths = reduce(Column.__add__, map(width, df.schema), F.lit(0))
    size = F.coalesce(F.sum(widths.cast("long")), F.lit(0))
    rows, held = df.agg(F.count(F.lit(1)), size).first()
    return rows <= BROADCAST_ROWS and held <= BROADCAST_BYTES


def measured(df: DataFrame) -> tuple[DataFrame, bool]:
    """``df`` written once, and whether it may be broadcast."""
    written = stable(df)
    return written, fits_broadcast(written)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Write a narrow table once, and mark it for broadcast if ``measured`` allows it."""
    written, small = measured(df)
    return F.broadcast(written) if small else written
