"""Block, outbox and log tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import canonical
from ..schemas import BLOCK

# Heights per folder of a written block table.
HEIGHT_BUCKET = 100_000


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Deal out a scan, for costly per-row work: about ``rows`` rows a task, and a task for each core at least.

    The rows of a scan stand where its row groups begin, so many of its partitions
    may be empty, and one may hold most of the table. Partitions are counted by a
    job that reads no column; a scan that has its rows spread passes through
    without a shuffle. Rows go round, whatever their keys are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    held = [r[0] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).select("count(1)").collect()]
    if len(held) >= cores and max(held) <= rows:
        return df
    return df.repartition(max(cores, -(-sum(held) // rows)))


def in_height_range(df: DataFrame, number: str, low: int | None, high: int | None) -> DataFrame:
    """Blocks from ``low`` to ``high``; the bare comparisons reach the scan."""
    if low is not None:
        df = df.filter(F.col(number) >= low)
    if high is not None:
        df = df.filter(F.col(number) <= high)
    return df


def write_blocks(df: DataFrame, path: str, mode: str = "append") -> None:
    """Canonical blocks in folders by height, so a height range reads few files.

    Rows are spread by hash within a folder's heights rather than sent to one
    task per folder.
    """
    bucket = F.call_function("div", F.col("header.number"), F.lit(HEIGHT_BUCKET))
    (
        df.withColumn("height_bucket", bucket)
        .repartitionByRange("height_bucket", "header.number", "hash")
        .write.mode(mode)
        .partitionBy("height_bucket")
        .parquet(path)
    )


def read_blocks(
    spark: SparkSession, path: str, low: int | None = None, high: int | None = None
) -> DataFrame:
    """A written block table, pruned to a height range."""
    df = spark.read.schema(
        T.StructType([*BLOCK.fields, T.StructField("height_bucket", T.LongType())])
    ).parquet(path)
    if low is not None:
        df = df.filter(F.col("height_bucket") >= low // HEIGHT_BUCKET)
    if high is not None:
        df = df.filter(F.col("height_bucket") <= high // HEIGHT_BUCKET)
    return in_height_range(df, "header.number", low, high).drop("height_bucket")


def read_json_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Raw blocks, one JSON object per line, as a canonical ``block`` column."""
    lines = spark.read.text(path).withColumnRenamed("value", "payload")
    return canonical.decode_payload(lines)


def outbox_messages(
    df: DataFrame, message_id: Column, scanned_at_ms: Column, block: str = "block"
) -> DataFrame:
    """Outbox rows (all strings) of canonical blocks."""
    return df.select(
        message_id.cast("string").alias("id"),
        F.col(f"{block}.hash").alias("hash"),
        F.col(f"{block}.header.number").cast("string").alias("number"),
        F.expr(canonical.encode_payload(block)).alias("payload"),
        scanned_at_ms.cast("string").alias("scanned_at_ms"),
    )


def follow_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    only: str | None = None,
) -> DataFrame:
    """A stream over a growing folder, from its first file on."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if only:
        reader = reader.option("pathGlobFilter", only)
    return reader.parquet(path)


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text logs as ``line`` with the file each came from."""
    return spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("path")
    )
