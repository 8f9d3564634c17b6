"""Publishing works on what is published, and parts of any number of files arrive in order."""

import json

from pyspark.sql import functions as F

from heightline.operators import contract
from heightline.plans import follow
from heightline.schemas import OUTBOX
from heightline.streaming import publish


def message(i, hash_, payload=None, number="7"):
    payload = json.dumps({"hash": hash_, "header": {"number": i}}) if payload is None else payload
    return (f"{i}-0", hash_, number, payload, str(i))


def test_blocks_are_mapped_of_published_messages_only(spark, tmp_path, monkeypatch):
    big = json.dumps({"hash": "0xccc", "header": {"extra": "0x" + "ab" * 3000}})
    rows = [
        *(message(i, "0xaaa") for i in range(1, 6)), message(6, "0xbbb"), message(7, "0xddd", "{"),
        message(8, "0xccc", big), message(9, "0xccc"),
    ]
    mapped = []
    check = contract.check_messages

    def spy(df):
        mapped.extend(r.id for r in df.select("id").collect())
        return check(df)

    monkeypatch.setattr(contract, "check_messages", spy)
    df = spark.createDataFrame(rows, OUTBOX)
    plan = publish.PublishPlan(topic="blocks", max_record_bytes=5000)
    publish.publish_batch(df, 0, str(tmp_path), plan, lambda: 1000, ["id"])
    assert sorted(mapped) == ["1-0", "6-0", "9-0"]
    out = publish.Publisher(spark, str(tmp_path))
    assert sorted(bytes(r.key).hex()[-3:] for r in out.records.rows().collect()) == ["aaa", "bbb", "ccc"]
    assert sorted((r.id, r.reason) for r in out.quarantine.rows().collect()) == [
        ("7-0", "payload_undecodable"), ("8-0", "record_too_large")]
    mapped.clear()
    once = publish.publish_once(df, spark.createDataFrame([("0x" + "aaa".zfill(64), 1)], "hash string, published_at long"), plan, 9, ["id"])
    assert sorted(r.id for r in once.collect()) == ["6-0", "9-0"] == sorted(mapped)


def test_messages_are_judged_as_they_are_checked(spark):
    zero = "0x" + "0" * 64
    payloads = [
        "{}", "null", "{", "", '{"hash":5}', '{"hash":"0x1"}', '{"hash":" 0XAB "}', f'{{"hash":"{zero}"}}', '{"header":{"gasUsed":-5}}',
        '{"uncles":[' + ",".join(["{}"] * 40) + "]}", '{"transactions":[' + ",".join(["null"] * 40) + "]}",
        '{"transactions":[{"accessList":[' + ",".join(['{"storageKeys":["",""]}'] * 30) + "]}]}",
        '{"withdrawals":[' + ",".join(["{}"] * 40) + "]}", '{"header":{"extra":"0x' + "ab" * 4000 + '","difficulty":"0x' + "f" * 400 + '"}}',
    ]
    rows = [message(i, h, p, n) for i, p in enumerate(payloads) for h in ("0xABC", "", None, zero, "junk") for n in ("7", "x")]
    df = spark.createDataFrame(rows, OUTBOX).withColumn("row", F.monotonically_increasing_id())
    plan = publish.PublishPlan(topic="blocks")
    size = {r.row: (r.reason, r.hash, r.size) for r in publish.records.block_records(contract.check_messages(df), plan.topic)
            .select("row", "reason", F.col("block.hash").alias("hash"), F.octet_length("value").alias("size")).collect()}
    for limit in (0, 1300, 5000, 20000, 10**6):
        judged = contract.judge_messages(df, limit).collect()
        assert len(judged) == len(rows)
        for r in judged:
            reason, hash_, n = size[r.row]
            assert r.reason == reason
            if reason is None:
                assert (r.block_hash, r.large) == (hash_, 0 < limit < n)
    assert not any(r.large for r in judged)


def test_a_part_of_many_files_is_one_batch(spark, tmp_path):
    files = follow.FILES_PER_BATCH + 6
    rows = spark.range(4 * files).repartition(files)
    batches = []

    def run(stream):
        return (
            stream.writeStream.foreachBatch(lambda df, epoch: batches.append([r.id for r in df.collect()]))
            .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        )

    follow._over_restarts(spark, rows, "id", str(tmp_path), run)
    assert len(batches) == follow.PARTS
    assert sorted(sum(batches, [])) == list(range(4 * files))
    assert all(max(a) < min(b) for a, b in zip(batches, batches[1:]))
