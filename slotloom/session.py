"""Session settings, the shared scratch folder, and size checks before a broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its measured size stays below this many bytes.
BROADCAST_LIMIT = 256 * 1024 * 1024


def local_session(cores: int | str = 8, app: str = "slotloom", **conf: str) -> SparkSession:
    """A session for one machine; on a cluster use the session the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SLOTLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(df: DataFrame, key: str) -> DataFrame:
    """A table of few splits over all cores; one that has a split per core stays as it is.

    A small Parquet file is often a single row group, which one task reads.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table, below the shared folder named in spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.conf.get("spark.master", None) or "").startswith("local["):
            raise ValueError("name a folder that the driver and all executors share in spark.checkpoint.dir")
        # One process on one machine, where a local folder does.
        root = tempfile.mkdtemp(prefix="slotloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def is_small(df: DataFrame, column: str, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether the table measures below ``limit`` bytes; ``column`` is its widest column, summed by one aggregate."""
    is_array = df.schema[column].dataType.typeName() == "array"
    width = F.size(column) * F.lit(8) if is_array else F.octet_length(F.col(column))
    measured = df.agg(F.sum(width.cast("long") + F.lit(64)).alias("n")).first()["n"] or 0
    return measured <= limit


def broadcast_if_small(df: DataFrame, column: str, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast when the table measures below ``limit``; else leave the plan to Spark.

    Beyond the limit the join shuffles, and adaptive execution splits the
    partitions of hot keys.
    """
    return F.broadcast(df) if is_small(df, column, limit) else df


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table once into the shared scratch folder and read it back.

    Several consumers then share one computation, later plans stay short, and a
    lost executor costs no recomputation from the source.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, name: str, *order) -> DataFrame:
    """``df``, written once, with ``_range``: the number of the range of ``order`` that a row lies in.

    Sums and ranks over a whole table are taken range by range, on top of one total per range.
    """
    return stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
