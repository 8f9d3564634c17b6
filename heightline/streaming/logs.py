"""Container logs to labelled lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import logs
from ..schemas import STRING, struct
from ..sources.epochs import EpochTable

# The container an entry comes from is a part of its path.
CONTAINER_IN_PATH = "container=([^/]+)/"

LINE = struct(
    container=STRING, service=STRING, compose_project=STRING, stream=STRING, instance=STRING, level=STRING,
    ts=T.TimestampType(), line=STRING,
)
ASIDE = struct(container=STRING, line=STRING)


def follow_log_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of growing log files with the path each came from, from their first line on."""
    reader = spark.readStream.schema("line STRING").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select("line", F.col("_metadata.file_path").alias("path"))


def labelled(lines: DataFrame, containers: DataFrame, pattern: str, path_pattern: str = CONTAINER_IN_PATH) -> DataFrame:
    """Unwrapped lines with the labels of their container and those found in the line.

    ``containers`` has what discovery knows: id, name (with a slash before it),
    service and project, one row each; a container it does not know has no
    labels. Lines of the log shipper itself are dropped. Lines of services that
    match ``pattern`` are read as logfmt, and service and instance found there
    stand in for the labels; other lines pass as they are.
    """
    found = lines.withColumn("id", F.regexp_extract("path", path_pattern, 1)).drop("path")
    named = found.join(
        containers.select("id", F.col("name").alias("meta_name"), "service", F.col("project").alias("compose_project")),
        "id",
        "left",
    )
    named = logs.relabel(named, "meta_name", logs.CONTAINER_PATTERN, "container")
    named = logs.drop_matching(named, "container", logs.DROPPED_CONTAINER)
    unwrapped = logs.unwrap_docker(named)
    read = logs.extract_logfmt(unwrapped, "line", "service", pattern)
    return logs.promote_labels(read).withColumnRenamed("log_level", "level")


class LogTables:
    """Tables of one ingest job below ``path``: labelled lines, and what could not be unwrapped."""

    def __init__(self, spark: SparkSession, path: str):
        self.lines = EpochTable(spark, f"{path}/lines", LINE)
        self.aside = EpochTable(spark, f"{path}/aside", ASIDE)


def ingest_logs(
    lines: DataFrame, containers: DataFrame, path: str, checkpoint: str, pattern: str, **trigger
) -> StreamingQuery:
    """Write the labelled lines of a stream of (line, path), and set broken ones aside."""

    def step(batch: DataFrame, epoch: int) -> None:
        out = LogTables(batch.sparkSession, path)
        found = labelled(batch, containers, pattern).persist()
        try:
            out.lines.write(found.filter("NOT broken"), epoch)
            out.aside.write(found.filter("broken"), epoch)
        finally:
            found.unpersist()

    return (
        lines.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
