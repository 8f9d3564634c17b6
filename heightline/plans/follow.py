"""Queries that run a stream over a whole table to its end and read what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import backlog
from ..schemas import struct
from ..session import work_path
from ..sources.epochs import EpochTable
from ..sources.tables import follow_parquet
from ..streaming import heads as head_stream
from ..streaming import publish as publish_job
from ..streaming import logs as log_stream
from ..streaming.dedup import ROCKSDB, dedup_ttl_batches, dedup_ttl_state
from ..streaming.progress import ProgressLog
from . import inputs
from .chain import _HEADS
from .outbox import DEDUP_TTL_SQL, NOW, PUBLISH, PUBLISH_ONCE_SQL, _ENTRIES
from .registry import query

FILES_PER_BATCH = 64
# A table arrives in so many parts; the stream is stopped and started again after each.
PARTS = 4


def _over_restarts(spark, rows, order, path, run):
    """Hand ``rows`` to a stream in parts by ``order``, and run it to its end after each part.

    ``run`` gets the stream of the folder the parts arrive in. It starts from its
    checkpoint each time, so state has to outlast both batches and queries. A part
    is one batch: the files of a part are not in order, and batches of some of them
    would not be either.
    """
    cuts = rows.approxQuantile(order, [i / PARTS for i in range(1, PARTS)], 0.01)
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = rows
        if low is not None:
            part = part.filter(F.col(order) >= low)
        if high is not None:
            part = part.filter(F.col(order) < high)
        elif low is not None:
            # Rows without an order come with the last part.
            part = rows.filter((F.col(order) >= low) | F.col(order).isNull())
        part.coalesce(FILES_PER_BATCH).write.mode("append").parquet(f"{path}/in")
        run(follow_parquet(spark, f"{path}/in", rows.schema, FILES_PER_BATCH)).awaitTermination()


def _first_to_top(number: str, rows: str) -> str:
    return f"""
        SELECT chain, unnest(range(low, high + 1)) AS height FROM (
            SELECT chain, arg_min({number}, (arrived, number)) AS low, max({number}) AS high
            FROM ({rows}) WHERE {number} IS NOT NULL GROUP BY chain)"""


@query("stream_new_heads", _first_to_top("number", _HEADS))
def stream_new_heads(spark, sf):
    path = work_path(spark, "heads")
    rows = inputs.heads(spark, sf).select("chain", "number", "arrived")
    order = F.struct("arrived", "number")
    _over_restarts(
        spark, rows, "arrived", path,
        lambda heads: head_stream.follow_heads(heads, f"{path}/out", f"{path}/checkpoint", order),
    )
    return head_stream.written_heights(spark, f"{path}/out")


# One chain has lost its name, and is followed like the others.
_NAMELESS = f"SELECT nullif(chain, 'P') AS chain, number, arrived FROM ({_HEADS})"


@query("stream_null_chain", _first_to_top("number", _NAMELESS))
def stream_null_chain(spark, sf):
    path = work_path(spark, "null-chain")
    rows = inputs.heads(spark, sf).select(F.expr("nullif(chain, 'P')").alias("chain"), "number", "arrived")
    order = F.struct("arrived", "number")
    _over_restarts(
        spark, rows, "arrived", path,
        lambda heads: head_stream.follow_heads(heads, f"{path}/out", f"{path}/checkpoint", order),
    )
    return head_stream.written_heights(spark, f"{path}/out")


_POLLED = f"""
    SELECT *, CASE WHEN chain = 'F' AND NOT ok THEN number
                   WHEN number >= {inputs.CONFIRMATIONS} THEN number - {inputs.CONFIRMATIONS}
              END AS final FROM ({_HEADS})"""


@query("stream_finalized", _first_to_top("final", _POLLED))
def stream_finalized(spark, sf):
    path = work_path(spark, "finalized")
    polls = inputs.heads(spark, sf).select(
        "chain",
        F.when((F.col("chain") == "F") & ~F.col("ok"), F.col("number")).alias("tag"),
        F.col("number").alias("latest"),
        "arrived",
    )
    order = F.struct("arrived", "latest")
    _over_restarts(
        spark, polls, "arrived", path,
        lambda rows: head_stream.follow_finalized(
            rows, f"{path}/out", f"{path}/checkpoint", order, inputs.CONFIRMATIONS
        ),
    )
    return head_stream.written_heights(spark, f"{path}/out")


@query("read_new", f"SELECT id, hash, at_ms AS id_ms FROM ({_ENTRIES})")
def read_new(spark, sf):
    path = work_path(spark, "read-new")
    table = EpochTable(
        spark, f"{path}/out", struct(id=T.StringType(), hash=T.StringType(), id_ms=T.LongType())
    )

    def handle(batch, epoch):
        table.write(backlog.with_id_parts(batch), epoch)

    _over_restarts(
        spark, inputs.entries(spark, sf).select("id", "hash", "at_us"), "at_us", path,
        lambda entries: entries.select("id", "hash").writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(),
    )
    return table.rows()


@query("stream_dedup_ttl", DEDUP_TTL_SQL)
def stream_dedup_ttl(spark, sf):
    path = work_path(spark, "dedup")
    rows = inputs.entries(spark, sf).select("user_id", "event_id", "at_us")
    _over_restarts(
        spark, rows, "at_us", path,
        lambda stream: dedup_ttl_batches(
            stream, f"{path}/out", f"{path}/checkpoint", "user_id", "at_us", inputs.DAY_US, ["event_id"]
        ),
    )
    return EpochTable(spark, f"{path}/out", rows.schema).rows()


@query("stream_dedup_state", DEDUP_TTL_SQL)
def stream_dedup_state(spark, sf):
    path = work_path(spark, "dedup-state")
    rows = inputs.entries(spark, sf).select("user_id", "event_id", "at_us")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKSDB)
    try:
        _over_restarts(
            spark, rows, "at_us", path,
            lambda stream: dedup_ttl_state(stream, "user_id", "at_us", inputs.DAY_US, ["event_id"])
            .writeStream.format("parquet")
            .option("path", f"{path}/out")
            .option("checkpointLocation", f"{path}/checkpoint")
            .trigger(availableNow=True)
            .start(),
        )
    finally:
        spark.conf.set(provider, before)
    return spark.read.schema(rows.schema).parquet(f"{path}/out")


_LOG_MINE = f"regexp_full_match(service, '{inputs.SERVICE_PATTERN}')"


@query(
    "stream_docker_logs",
    f"""WITH l AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS k,
                          substr(meta_container, 2) AS container,
                          'time=' || event_id || ' level=' || level
                          || ' msg="user said level=none and \\"left\\"" service="' || service
                          || '" instance=' || instance || ' err=' || props AS line
                   FROM ({inputs.LOG_LINES_SQL}) JOIN (SELECT event_id, props FROM events) USING (event_id)),
        e AS (SELECT *, '{{"log":"' || replace(replace(line, '\\', '\\\\'), '"', '\\"') || '\\n","stream":"stdout","time":"'
                     || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}}' AS entry FROM l WHERE container <> 'promtail')
        SELECT container, k IN (3, 7, 11) AS broken, CASE WHEN k NOT IN (3, 7, 11) THEN epoch_us(ts) END AS at_us,
               CASE WHEN k NOT IN (3, 7, 11) THEN service END AS service,
               CASE WHEN k NOT IN (3, 7, 11) AND {_LOG_MINE} THEN instance END AS instance,
               CASE WHEN k NOT IN (3, 7, 11) AND {_LOG_MINE} THEN level END AS level,
               CASE WHEN k NOT IN (3, 7, 11) THEN 'stdout' END AS stream,
               sha256(CASE k WHEN 3 THEN substr(entry, 1, 40) WHEN 7 THEN line
                             WHEN 11 THEN replace(entry, '"time"', '"tome"') ELSE line END) AS line_sha256
        FROM e""",
)
def stream_docker_logs(spark, sf):
    path = work_path(spark, "docker-logs")
    # What discovery found is kept: a batch would look through the whole table for it again.
    inputs.containers(spark, sf).write.parquet(f"{path}/containers")
    containers = spark.read.parquet(f"{path}/containers")
    rows = inputs.docker_lines(spark, sf)
    cuts = [None, *rows.approxQuantile("at_us", [i / PARTS for i in range(1, PARTS)], 0.01), None]
    for low, high in zip(cuts, cuts[1:]):
        part = rows.filter((F.lit(True) if low is None else F.col("at_us") >= low) & (F.lit(True) if high is None else F.col("at_us") < high))
        part.select("container", "entry").write.mode("append").partitionBy("container").text(f"{path}/in")
        lines = log_stream.follow_log_files(spark, f"{path}/in", FILES_PER_BATCH)
        log_stream.ingest_logs(lines, containers, f"{path}/out", f"{path}/checkpoint", inputs.SERVICE_PATTERN).awaitTermination()
    out = log_stream.LogTables(spark, f"{path}/out")
    good = out.lines.rows().select(
        "container", F.lit(False).alias("broken"), F.unix_micros("ts").alias("at_us"), "service", "instance", "level",
        "stream", F.sha2("line", 256).alias("line_sha256"),
    )
    aside = out.aside.rows().select("container", F.lit(True).alias("broken"), F.sha2("line", 256).alias("line_sha256"))
    return good.unionByName(aside, allowMissingColumns=True)


@query("stream_saturation", "SELECT count(*) AS input_rows, TRUE AS all_batches FROM events")
def stream_saturation(spark, sf):
    path = work_path(spark, "saturation")
    table = EpochTable(spark, f"{path}/out", struct(id=T.StringType()))
    with ProgressLog(spark, f"{path}/updates") as log:
        queries = []

        def run(entries):
            queries.append(
                entries.writeStream.foreachBatch(lambda batch, epoch: table.write(batch, epoch))
                .option("checkpointLocation", f"{path}/checkpoint")
                .trigger(availableNow=True)
                .start()
            )
            return queries[-1]

        _over_restarts(spark, inputs.entries(spark, sf).select("id", "at_us"), "at_us", path, run)
        for query_ in queries:
            log.wait(query_)
    return log.rows().agg(
        F.sum("input_rows").alias("input_rows"), (F.count_distinct("batch_id") >= PARTS).alias("all_batches")
    )


@query("stream_publish_once", PUBLISH_ONCE_SQL)
def stream_publish_once(spark, sf):
    path = work_path(spark, "publish")
    out = publish_job.Publisher(spark, f"{path}/out", PUBLISH.marker_ttl)
    out.ledger.write(inputs.ledger(spark, sf), -1)
    _over_restarts(
        spark, inputs.messages(spark, sf), "at_us", path,
        lambda outbox: publish_job.publish_stream(
            outbox, f"{path}/out", f"{path}/checkpoint", PUBLISH, lambda: NOW, ["at_us", "event_id"]
        ),
    )
    written = out.records.rows()
    headers = F.transform("headers", lambda h: F.decode(h["value"], "UTF-8"))
    return written.select(
        headers[2].alias("id"),
        F.hex("key").alias("key_hex"),
        headers[0].alias("number"),
        F.decode("value", "UTF-8").alias("value"),
    )
