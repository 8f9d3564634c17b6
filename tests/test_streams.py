import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from heightline.operators import dedup
from heightline.schemas import OUTBOX
from heightline.sources import kafka, tables
from heightline.sources.epochs import EpochTable
from heightline.streaming import heads as head_stream
from heightline.streaming import publish
from heightline.streaming.dedup import accept_batch, dedup_ttl_batches, dedup_ttl_state
from heightline.streaming.progress import progress_table

EVENTS = "/root/testdata/sf0.001/events.parquet"
ORDERS = "/root/testdata/sf0.001/orders.parquet"
PLAN = publish.PublishPlan(topic="blocks", max_record_bytes=5000)


def add(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def message(i, hash_, number=1, payload=None):
    payload = payload or json.dumps({"hash": hash_, "header": {"number": number}})
    return (f"{i}-0", hash_, str(number), payload, str(i))


def run_publish(spark, tmp, **kw):
    q = publish.publish_stream(
        tables.follow_parquet(spark, str(tmp / "in"), OUTBOX, files_per_batch=1),
        str(tmp / "out"), str(tmp / "cp"), kw.pop("plan", PLAN), kw.pop("now", lambda: 1000), ["id"], **kw)
    q.awaitTermination()
    return q


def published(spark, tmp):
    return sorted(bytes(r.key).hex()[-3:] for r in publish.Publisher(spark, str(tmp / "out")).records.rows().collect())


def test_publish_each_hash_once_over_batches(spark, tmp_path):
    add(spark, tmp_path / "in", [message(1, "0xaaa"), message(2, "0xaaa"), message(3, "0xbbb")], OUTBOX)
    run_publish(spark, tmp_path)
    add(spark, tmp_path / "in", [message(4, "0xaaa"), message(5, "0xccc")], OUTBOX)
    run_publish(spark, tmp_path)
    assert published(spark, tmp_path) == ["aaa", "bbb", "ccc"]
    ledger = publish.Publisher(spark, str(tmp_path / "out")).ledger.rows()
    assert ledger.count() == 3


def test_crash_between_publish_and_marker(spark, tmp_path):
    add(spark, tmp_path / "in", [message(1, "0xaaa"), message(2, "0xbbb")], OUTBOX)

    def crash(epoch):
        raise RuntimeError("crash before the marker")

    with pytest.raises(Exception, match="crash before the marker"):
        run_publish(spark, tmp_path, before_ledger=crash)
    # Published but not marked: the entries are still pending.
    assert publish.Publisher(spark, str(tmp_path / "out")).ledger.rows().count() == 0
    sent = []
    run_publish(spark, tmp_path, send=lambda df: sent.extend(df.collect()))
    assert published(spark, tmp_path) == ["aaa", "bbb"] and len(sent) == 2
    assert publish.Publisher(spark, str(tmp_path / "out")).ledger.rows().count() == 2
    # Nothing is left to do.
    run_publish(spark, tmp_path)
    assert published(spark, tmp_path) == ["aaa", "bbb"]


def test_crash_before_publish(spark, tmp_path):
    add(spark, tmp_path / "in", [message(1, "0xaaa")], OUTBOX)

    def fail(df):
        raise RuntimeError("broker away")

    with pytest.raises(Exception, match="broker away"):
        run_publish(spark, tmp_path, send=fail)
    run_publish(spark, tmp_path)
    assert published(spark, tmp_path) == ["aaa"]


def test_poison_messages_go_to_quarantine(spark, tmp_path):
    big = json.dumps({"hash": "0xddd", "header": {"number": 1, "extra": "0x" + "ab" * 3000}})
    add(spark, tmp_path / "in", [message(1, "0xaaa", payload="{"), message(2, "0xddd", payload=big),
                                 message(3, "0xbbb")], OUTBOX)
    run_publish(spark, tmp_path)
    out = publish.Publisher(spark, str(tmp_path / "out"))
    assert sorted((r.id, r.reason) for r in out.quarantine.rows().collect()) == [
        ("1-0", "payload_undecodable"), ("2-0", "record_too_large")]
    assert published(spark, tmp_path) == ["bbb"]


def test_expired_marker_publishes_again(spark, tmp_path):
    plan = publish.PublishPlan(topic="blocks", marker_ttl=100)
    for i, now in enumerate((1000, 1099, 1100)):
        add(spark, tmp_path / "in", [message(i + 1, "0xaaa")], OUTBOX)
        run_publish(spark, tmp_path, plan=plan, now=lambda now=now: now)
    assert published(spark, tmp_path) == ["aaa", "aaa"]


def test_progress(spark, tmp_path):
    add(spark, tmp_path / "in", [message(1, "0xaaa")], OUTBOX)
    rows = progress_table(spark, run_publish(spark, tmp_path)).collect()
    assert sum(r.input_rows for r in rows) >= 1


def head_rows(spark, tmp, rows):
    add(spark, tmp / "in", rows, "chain string, number long, at long")


def run_heads(spark, tmp, on_heights=None):
    heads = tables.follow_parquet(
        spark, str(tmp / "in"), spark.read.parquet(str(tmp / "in")).schema, files_per_batch=1)
    head_stream.follow_heads(heads, str(tmp / "out"), str(tmp / "cp"), F.struct("at", "number"),
                             on_heights).awaitTermination()
    return sorted((r.chain, r.height) for r in head_stream.written_heights(spark, str(tmp / "out")).collect())


def test_heads_are_followed_over_restarts(spark, tmp_path):
    head_rows(spark, tmp_path, [("a", 3, 1), ("a", 5, 2)])
    assert run_heads(spark, tmp_path) == [("a", 3), ("a", 4), ("a", 5)]
    head_rows(spark, tmp_path, [("a", 8, 3), ("b", 2, 3), ("a", 4, 4)])
    assert run_heads(spark, tmp_path) == [("a", h) for h in range(3, 9)] + [("b", 2)]


def test_failed_handler_repeats_the_same_heights(spark, tmp_path):
    head_rows(spark, tmp_path, [("a", 3, 1), ("a", 5, 2)])

    def fail(df, epoch):
        raise RuntimeError("handler failed")

    with pytest.raises(Exception, match="handler failed"):
        run_heads(spark, tmp_path, fail)
    seen = []
    run_heads(spark, tmp_path, lambda df, epoch: seen.extend(r.height for r in df.collect()))
    assert sorted(seen) == [3, 4, 5]


def test_finalized_waits_for_depth(spark, tmp_path):
    schema = "chain string, tag long, latest long, at long"
    add(spark, tmp_path / "in", [("a", None, 5, 1), ("a", None, 12, 2)], schema)
    rows = tables.follow_parquet(spark, str(tmp_path / "in"),
                                 spark.read.parquet(str(tmp_path / "in")).schema)

    def run():
        head_stream.follow_finalized(rows, str(tmp_path / "out"), str(tmp_path / "cp"),
                                     F.struct("at", "latest"), 10).awaitTermination()
        return sorted(r.height for r in head_stream.written_heights(spark, str(tmp_path / "out")).collect())

    assert run() == [2]
    add(spark, tmp_path / "in", [("a", 4, 13, 3)], schema)
    assert run() == [2, 3, 4]


DAY = 86_400_000_000


def run_state_dedup(spark, tmp):
    schema = spark.read.parquet(str(tmp / "in")).schema
    stream = tables.follow_parquet(spark, str(tmp / "in"), schema, files_per_batch=1)
    kept = dedup_ttl_state(stream, "user_id", "us", DAY, ["event_id"])
    kept.writeStream.format("parquet").option("path", str(tmp / "out")).option(
        "checkpointLocation", str(tmp / "cp")).trigger(availableNow=True).start().awaitTermination()
    return sorted(r.event_id for r in spark.read.parquet(str(tmp / "out")).collect())


def run_batch_dedup(spark, tmp, floor=0):
    schema = spark.read.parquet(str(tmp / "in")).schema
    stream = tables.follow_parquet(spark, str(tmp / "in"), schema, files_per_batch=1)
    dedup_ttl_batches(stream, str(tmp / "out"), str(tmp / "cp"), "user_id", "us", DAY, ["event_id"],
                      floor=floor).awaitTermination()
    return sorted(r.event_id for r in EpochTable(spark, str(tmp / "out"), schema).rows().collect())


@pytest.mark.parametrize("run", [run_state_dedup, run_batch_dedup])
def test_dedup_stream_equals_batch_over_files_and_restarts(spark, tmp_path, run):
    # Half of all rows get one key.
    user = F.when(F.col("event_id") % 2 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    events = spark.read.parquet(EVENTS).select(
        user.cast("long").alias("user_id"), "event_id", F.col("ts").cast("timestamp").alias("at"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    want = dedup.dedup_ttl(events, "user_id", "us", DAY, ["event_id"])
    want = sorted(r.event_id for r in want.collect())
    # Three files in order of time, the last one after a restart.
    for low, high in ((0, 300), (300, 700), (700, 10**9)):
        events.filter((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
        if low:
            got = run(spark, tmp_path)
    assert got == want


def test_accepting_again_leaves_the_same_rows(spark, tmp_path):
    schema = "k string, at long, i long"
    table = EpochTable(spark, str(tmp_path), spark.createDataFrame([], schema).schema)
    batches = [[("a", 0, 1), ("a", 5, 2)], [("a", 9, 3), ("a", 10, 4), ("b", 1, 5)], []]
    for epoch in (0, 1, 1, 0, 1, 2):
        accept_batch(spark.createDataFrame(batches[epoch], schema), table, epoch, "k", "at", 10, ["i"])
    assert sorted(r.i for r in table.rows().collect()) == [1, 4, 5]


def test_epoch_table_replaces_an_epoch(spark, tmp_path):
    table = EpochTable(spark, str(tmp_path / "t"), spark.range(1).schema)
    assert table.rows().count() == 0
    table.write(spark.range(5), 0)
    table.write(spark.range(3), 1)
    table.write(spark.range(2), 1)
    assert (table.rows().count(), table.rows(before=1).count(), table.epoch(1).count()) == (7, 5, 2)
    assert table.epoch(-1).count() == 0
    with pytest.raises(AnalysisException):
        table.epoch(9)


def test_block_table_reads_only_its_heights(spark, tmp_path):
    from heightline.plans import inputs
    from heightline.operators import canonical

    blocks = canonical.with_block(inputs.order_blocks(spark, "/root/testdata/sf0.001")).select("block.*")
    tables.write_blocks(blocks, str(tmp_path / "blocks"))
    got = tables.read_blocks(spark, str(tmp_path / "blocks"), 100, 199)
    assert sorted(r.n for r in got.select(F.col("header.number").alias("n")).collect()) == list(range(100, 200))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(height_bucket" in plan
    assert "PushedFilters: [IsNotNull(header.number), GreaterThanOrEqual(header.number,100)" in plan


def test_json_block_lines(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"hash":"0x1","header":{"number":4}}\n{"hash":\n')
    got = tables.read_json_blocks(spark, str(tmp_path / "b.json")).collect()
    assert [r.block and r.block.header.number for r in got] == [4, None]


def test_kafka_options():
    made = kafka.producer_options("h:9092", "", 5 << 20, 20 << 20)
    assert made["kafka.acks"] == "all" and made["kafka.compression.type"] == "zstd"
    assert made["kafka.batch.size"] == str(5 << 20)
    assert int(made["kafka.max.request.size"]) > 20 << 20
    assert kafka.producer_options("h", " GZIP ")["kafka.compression.type"] == "gzip"
    assert "kafka.compression.type" not in kafka.producer_options("h", "brotli")


def test_ledger_time_filter_reaches_the_scan(spark, tmp_path):
    from heightline.operators import markers
    from heightline.schemas import LEDGER

    table = EpochTable(spark, str(tmp_path / "ledger"), LEDGER)
    table.write(spark.createDataFrame([("h", 5)], LEDGER), 0)
    table.write(spark.createDataFrame([("i", 50)], LEDGER), 1)
    live = markers.live_markers(table.rows(before=1), "published_at", 10, 20)
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(published_at,10)" in plan and "PartitionFilters: [isnotnull(epoch" in plan
    assert live.count() == 0


def test_log_files(spark, tmp_path):
    (tmp_path / "a.log").write_text("level=INFO\nlevel=WARN\n")
    got = tables.read_log_lines(spark, str(tmp_path)).collect()
    assert sorted(r.line for r in got) == ["level=INFO", "level=WARN"] and got[0].path.endswith("a.log")
