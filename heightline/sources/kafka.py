"""Kafka options and the record sink.

The connector is not part of Spark itself; a deployment adds its package. Record
columns are the same for a parquet sink, which tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Accepted compression names; blank means zstd.
COMPRESSIONS = ("none", "gzip", "snappy", "lz4", "zstd")
RECORD_COLUMNS = ("topic", "key", "value", "headers")


def producer_options(
    servers: str,
    compression: str = "",
    batch_bytes: int = 0,
    max_record_bytes: int = 0,
    client_id: str | None = None,
) -> dict[str, str]:
    """Writer options: wait for all replicas; unknown compressions are left unset."""
    options = {"kafka.bootstrap.servers": servers, "kafka.acks": "all", "includeHeaders": "true"}
    name = compression.strip().lower() or "zstd"
    if name in COMPRESSIONS:
        options["kafka.compression.type"] = name
    if batch_bytes > 0:
        options["kafka.batch.size"] = str(batch_bytes)
    if max_record_bytes > 0:
        # The guard counts the value; leave room for key and headers.
        options["kafka.max.request.size"] = str(max_record_bytes + 64 * 1024)
    if client_id:
        options["kafka.client.id"] = client_id
    return options


def write_records(df: DataFrame, options: dict[str, str]) -> None:
    df.select(*RECORD_COLUMNS).write.format("kafka").options(**options).save()


def follow_topic(spark: SparkSession, servers: str, topic: str, per_batch: int | None = None) -> DataFrame:
    """A topic as a stream from its first record, with headers."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("includeHeaders", "true")
    )
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load()
