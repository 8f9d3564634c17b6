"""The ledger of merged runs, and what a batch reads of it."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from heightline.schemas import LEDGER
from heightline.sources.epochs import EpochTable
from heightline.sources.ledger import Ledger
from heightline.streaming.dedup import accept_batch


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "hash string, published_at long")


def files(df):
    """Files that rows are read from."""
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_runs_cover_all_batches(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), LEDGER, "hash", "published_at", fan=3)
    for count in range(200):
        covered = list(ledger._covering(count))
        singles = [i for level, run in covered for i in range(run * 3**level, (run + 1) * 3**level)]
        assert singles == list(range(count))
        assert len(covered) <= 2 * 5


def test_a_batch_reads_its_buckets_and_live_slots_only(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), LEDGER, "hash", "published_at", slot=10, fan=3, buckets=4)
    ledger.write(rows(spark, [("old", 1), (None, 2)]), -1)
    read = []
    for epoch in range(9):
        at = 10 * epoch + 5
        batch = rows(spark, [(f"h{epoch}-{i}", at) for i in range(6)] + [("often", at)])
        live = ledger.rows(before=epoch, since=at - 30, keys=rows(spark, [("often", 0)]))
        seen = sorted(r.published_at for r in live.where("hash = 'often'").collect())
        assert seen == [10 * e + 5 for e in range(max(0, epoch - 2), epoch)]
        paths = [p for level, run in ledger._covering(epoch + 1) if (df := ledger._run(level, run)) is not None
                 for p in files(df.where(F.col("slot") >= (at - 30) // 10).where(F.col("bucket") == ledger_bucket(spark, "often")))]
        read.append(len(paths))
        ledger.write(batch, epoch, at - 30)
    # One bucket of at most four slots, in at most two single runs and two merged ones.
    assert max(read) <= 8 and max(read[-3:]) <= max(read[3:6]) + 1
    everything = ledger.rows()
    assert everything.where("hash = 'often'").count() == 9 and everything.where("hash IS NULL").count() == 1
    # Merges have left out what had expired for the batch that made them.
    assert ledger.rows(before=9).where("hash = 'old'").count() == 0


def ledger_bucket(spark, key):
    return spark.createDataFrame([(key,)], "hash string").select(F.pmod(F.xxhash64("hash"), F.lit(4))).first()[0]


def test_writing_again_replaces_a_run(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), LEDGER, "hash", "published_at", fan=2)
    for epoch in (0, 1, 1, 2, 2):
        ledger.write(rows(spark, [(f"h{epoch}", epoch)]), epoch)
    assert sorted(r.hash for r in ledger.rows(before=3).collect()) == ["h0", "h1", "h2"]
    assert sorted(r.hash for r in ledger.rows(before=2).collect()) == ["h0", "h1"]
    assert ledger.rows(before=0).count() == 0


def test_a_lost_run_is_an_error(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), LEDGER, "hash", "published_at")
    assert ledger.rows(before=0).count() == 0 and ledger.rows().count() == 0
    ledger.write(rows(spark, [("a", 1)]), 0)
    with pytest.raises(AnalysisException):
        ledger.rows(before=3)


def test_null_and_empty_batches(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), LEDGER, "hash", "published_at", slot=5)
    ledger.write(rows(spark, []), 0)
    ledger.write(rows(spark, [(None, -3), ("", 4)]), 1)
    got = ledger.rows(before=2, since=-10, keys=rows(spark, [(None, 0)]))
    assert [(r.hash, r.published_at) for r in got.collect() if r.hash is None] == [(None, -3)]


def test_null_keys_are_carried_over_batches(spark, tmp_path):
    schema = "k string, at long, i long"
    table = EpochTable(spark, str(tmp_path), spark.createDataFrame([], schema).schema)
    for epoch, batch in enumerate([[(None, 0, 1)], [(None, 9, 2), ("a", 9, 3)], [(None, 10, 4), ("a", 18, 5)], [("a", 19, 6)]]):
        accept_batch(spark.createDataFrame(batch, schema), table, epoch, "k", "at", 10, ["i"])
    assert sorted(r.i for r in table.rows().collect()) == [1, 3, 4, 6]
