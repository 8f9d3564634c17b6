"""Costly work is dealt out, and done once."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from heightline.functions import hexes
from heightline.plans import follow, inputs
from heightline.plans.catalog import ORACLE, QUERIES


@pytest.fixture
def tables(spark, tmp_path):
    """Tables of one row group each, with far more splits than that."""
    rows = spark.range(1000).coalesce(1)
    rows.select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(7.5).alias("o_totalprice"), F.expr("timestamp_ntz '2024-01-01'").alias("o_orderdate"),
        F.lit("5-LOW").alias("o_orderpriority"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    rows.select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        (F.col("id") % 9).alias("user_id"), F.expr("element_at(array('click', 'signup', 'view'), cast(id % 3 + 1 AS INT))").alias("event_type"),
        F.lit(1.0).alias("value"), F.format_string('{"k": %s}', F.col("id") % 100).alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    rows.limit(20).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("a\n\nb"), F.col("id")).alias("text"), F.lit(5).cast("bigint").alias("n_chars"),
    ).write.parquet(f"{tmp_path}/documents.parquet")
    settings = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield str(tmp_path)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rows_of_one_row_group_are_dealt_out(spark, tables):
    for made in (inputs.order_blocks(spark, tables), inputs.messages(spark, tables)):
        held = [r[0] for r in made.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).select("count(1)").collect()]
        assert sum(held) == 1000
        assert max(held) <= 300


def test_lists_are_mapped_once(spark, tables):
    for name in ("uncles_map", "tx_map", "withdrawal_map", "nested_uncles", "nested_transactions", "nested_withdrawals"):
        df = QUERIES[name](spark, tables)
        assert df.count() == 60
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain("extended")
        optimized = plan.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
        assert not [line for line in optimized.splitlines() if "Filter" in line[:60] and "size(" in line], name
    assert set(QUERIES) == set(ORACLE)


def test_batches_of_logs_do_not_look_through_the_events(spark, tables, monkeypatch):
    seen = []
    ingest = follow.log_stream.ingest_logs

    def watched(lines, containers, *args, **kwargs):
        seen.extend(containers.inputFiles())
        return ingest(lines, containers, *args, **kwargs)

    monkeypatch.setattr(follow.log_stream, "ingest_logs", watched)
    assert QUERIES["stream_docker_logs"](spark, tables).count() == sum(1 for i in range(1000) if i % 3 != 1)
    assert seen and not [f for f in seen if "events.parquet" in f]


def test_canonical_text_and_what_only_looks_like_it(spark):
    values = ["0x" + "ab" * 32, "0x" + "ab" * 31 + "gg", "0x" + "aB" * 32, "0X" + "ab" * 32, "0x" + "a" * 63, None, "0x", "0xab\n", "AbC", " 0xAB", "éé"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string").orderBy("i")
    full = "0x" + "ab" * 32
    got = df.select(F.expr(hexes.hash32("s")).alias("h"), F.expr(hexes.clean_hex("s")).alias("c")).collect()
    assert [r.c for r in got] == [full, None, full, full, None, None, None, "0xab", None, "0xab", None]
    assert [r.h for r in got][:6] == [full, "0x00" + "ab" * 31, full, full, "0x0" + "a" * 63, hexes.ZERO_HASH]
