"""Outbox to records, each hash once, across failures and restarts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import contract, markers, records
from ..schemas import LEDGER, QUARANTINE, RECORD
from ..sources.epochs import EpochTable
from ..sources.ledger import Ledger

TOO_LARGE = "record_too_large"
# Time slots of the ledger that one time-to-live covers.
SLOTS_PER_TTL = 1


@dataclass(frozen=True)
class PublishPlan:
    """Where records go and what stops one; ``marker_ttl`` is in the unit of ``now``, 0 is for ever."""

    topic: str
    max_record_bytes: int = 0
    marker_ttl: int = 0


def shaped(chosen: DataFrame, plan: PublishPlan) -> DataFrame:
    """Messages that are published, with their record."""
    checked = contract.check_messages(chosen)
    return records.block_records(checked, plan.topic, extras=records.source_header(F.col("id")))


def sound(judged: DataFrame) -> DataFrame:
    """Messages that keep the contract, under the hash of their block."""
    return judged.filter(F.col("reason").isNull()).withColumn("hash", F.col("block_hash"))


def chosen(good: DataFrame, live: DataFrame, order: list[str]) -> DataFrame:
    """Of sound messages those to publish: the first of each hash without a marker that is not too large."""
    return markers.first_unmarked(good.filter(~F.col("large")), live, "hash", order).drop("block_hash", "large")


class Publisher:
    """Tables of one publishing job below ``path``: records, ledger, quarantine."""

    def __init__(self, spark, path: str, marker_ttl: int = 0):
        self.records = EpochTable(spark, f"{path}/records", RECORD)
        self.ledger = Ledger(spark, f"{path}/ledger", LEDGER, "hash", "published_at", slot=marker_ttl // SLOTS_PER_TTL)
        self.quarantine = EpochTable(spark, f"{path}/quarantine", QUARANTINE)


def publish_batch(
    messages: DataFrame,
    epoch: int,
    path: str,
    plan: PublishPlan,
    now: Callable[[], int],
    order: list[str],
    send: Callable[[DataFrame], None] | None = None,
    before_ledger: Callable[[int], None] | None = None,
) -> None:
    """Check, publish, then mark one micro-batch.

    Every write replaces its epoch, and only markers of earlier epochs are
    looked at, so running a batch again writes the same records. Of the ledger,
    live markers in the buckets of the batch's hashes are read. What is kept of
    a message is its text and what was found of it; blocks are mapped and records
    made of those that are published. ``send`` hands the written records to a
    broker; that step can repeat, and the newest record per key removes the
    repeat on the reading side.
    """
    spark = messages.sparkSession
    out = Publisher(spark, path, plan.marker_ttl)
    at = now()
    since = at - plan.marker_ttl if plan.marker_ttl > 0 else None
    # Judged once, on shared storage: one batch takes the place of the last.
    judged = contract.judge_messages(messages, plan.max_record_bytes)
    judged.write.mode("overwrite").parquet(f"{path}/judged")
    judged = spark.read.schema(judged.schema).parquet(f"{path}/judged")
    good = sound(judged)
    asked = good.select("hash").distinct()
    live = out.ledger.rows(before=epoch, since=since, keys=asked)
    # The batch is small and its size is known by now, the ledger is not:
    # cut the ledger down to the batch's hashes before anything shuffles.
    live = live.join(asked, "hash", "left_semi")
    bad = judged.filter(F.col("reason").isNotNull()).select(*QUARANTINE.names)
    large = markers.without_marked(good.filter("large"), live, "hash").withColumn("reason", F.lit(TOO_LARGE))
    out.quarantine.write(bad.unionByName(large.select(*QUARANTINE.names)), epoch)
    out.records.write(shaped(chosen(good, live, order), plan), epoch)
    written = out.records.epoch(epoch)
    if send is not None:
        send(written)
    if before_ledger is not None:
        before_ledger(epoch)
    # From the written records, so that the ledger is what was published.
    marked = written.select("hash", F.lit(at).cast("bigint").alias("published_at"))
    out.ledger.write(marked, epoch, since)


def publish_stream(
    outbox: DataFrame,
    path: str,
    checkpoint: str,
    plan: PublishPlan,
    now: Callable[[], int],
    order: list[str],
    send: Callable[[DataFrame], None] | None = None,
    before_ledger: Callable[[int], None] | None = None,
    **trigger,
) -> StreamingQuery:
    def step(batch: DataFrame, epoch: int) -> None:
        publish_batch(batch, epoch, path, plan, now, order, send, before_ledger)

    return (
        outbox.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def publish_once(
    messages: DataFrame, ledger: DataFrame, plan: PublishPlan, now: Column | int, order: list[str]
) -> DataFrame:
    """The batch form: the records a set of messages would publish, made of the messages that are."""
    live = markers.live_markers(ledger, "published_at", plan.marker_ttl, now)
    judged = contract.judge_messages(messages, plan.max_record_bytes)
    return shaped(chosen(sound(judged), live, order), plan)
