"""Container logs over several batches, all updates of a stream, and state that outlasts restarts."""

import json

from heightline.operators import logs
from heightline.sources import tables
from heightline.streaming import logs as log_stream
from heightline.streaming.dedup import ROCKSDB, dedup_ttl_state
from heightline.streaming.progress import ProgressLog


def entry(line, at="2024-01-05T10:00:00.123456789Z", **more):
    return json.dumps({"log": line, "stream": "stderr", "time": at, **more})


def test_unwrap_docker(spark):
    texts = [
        entry("level=INFO msg=\"a \\\"b\\\"\"\n"), entry("no end"), entry("two\r\n"), entry("\n"), "level=INFO", '{"log":"cut',
        json.dumps({"stream": "stdout", "time": "2024-01-05T10:00:00Z"}), entry("x", at="soon"), "", None, "[1]", entry("ok\n", extra={"a": 1}),
    ]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "i int, line string, stream string")
    got = {r.i: r for r in logs.unwrap_docker(df).collect()}
    assert [got[i].line for i in (0, 1, 2, 3, 11)] == ['level=INFO msg="a \\"b\\""', "no end", "two", "", "ok"]
    assert [i for i in sorted(got) if got[i].broken] == [4, 5, 6, 7, 8, 9, 10]
    assert all(got[i].line == texts[i] and got[i].stream is None and got[i].ts is None for i in range(4, 11))
    assert got[0].stream == "stderr" and got[0].ts.microsecond == 123456


CONTAINERS = [("c1", "/scanner", "scanner", "p"), ("c2", "/db", "db", "p"), ("c3", "/promtail", "logs", "p")]


def write_log(tmp, container, name, lines):
    folder = tmp / "in" / f"container={container}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(x + "\n" for x in lines))


def run_logs(spark, tmp):
    known = spark.createDataFrame(CONTAINERS, "id string, name string, service string, project string")
    lines = log_stream.follow_log_files(spark, str(tmp / "in"), files_per_batch=1)
    log_stream.ingest_logs(lines, known, str(tmp / "out"), str(tmp / "cp"), "scanner").awaitTermination()
    return log_stream.LogTables(spark, str(tmp / "out"))


def test_logs_become_labelled_lines_over_batches(spark, tmp_path):
    write_log(tmp_path, "c1", "a-json.log", [entry("level=WARN instance=r1 service=mine\n"), "broken"])
    write_log(tmp_path, "c2", "b-json.log", [entry("level=WARN instance=r1\n")])
    run_logs(spark, tmp_path)
    write_log(tmp_path, "c3", "c-json.log", [entry("shipped\n"), "broken"])
    write_log(tmp_path, "c9", "d-json.log", [entry("stranger\n")])
    out = run_logs(spark, tmp_path)
    got = sorted((r.container or "", r.service or "", r.instance or "", r.level or "", r.line[:8]) for r in out.lines.rows().collect())
    assert got == [
        ("", "", "", "", "stranger"), ("db", "db", "", "", "level=WA"), ("scanner", "mine", "r1", "WARN", "level=WA"),
    ]
    assert [tuple(r) for r in out.aside.rows().collect()] == [("scanner", "broken")]
    # Nothing is read again.
    assert run_logs(spark, tmp_path).lines.rows().count() == 3


def test_all_updates_are_kept(spark, tmp_path):
    for i in range(6):
        spark.range(i + 1).write.mode("append").parquet(str(tmp_path / "in"))
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")
    try:
        with ProgressLog(spark, str(tmp_path / "updates")) as log:
            rows = tables.follow_parquet(spark, str(tmp_path / "in"), spark.range(1).schema, files_per_batch=1)
            query = (
                rows.writeStream.foreachBatch(lambda df, epoch: df.count())
                .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            )
            query.awaitTermination()
            assert log.wait(query)
    finally:
        spark.conf.unset(key)
    got = log.rows().collect()
    assert len(query.recentProgress) <= 2 < len({r.batch_id for r in got})
    assert sum(r.input_rows for r in got) == sum(len(range(i + 1)) for i in range(6))
    assert {r.query for r in got} == {str(query.id)} and all(r.duration_ms > 0 for r in got)


def run_state(spark, tmp):
    schema = "k string, at long, i long"
    stream = tables.follow_parquet(spark, str(tmp / "in"), spark.createDataFrame([], schema).schema, files_per_batch=1)
    dedup_ttl_state(stream, "k", "at", 10, ["i"]).writeStream.format("parquet").option("path", str(tmp / "out")).option(
        "checkpointLocation", str(tmp / "cp")).trigger(availableNow=True).start().awaitTermination()
    return sorted(r.i for r in spark.read.schema(schema).parquet(str(tmp / "out")).collect())


def test_state_outlasts_restarts_and_late_rows(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    parts = [
        [("a", 0, 1), (None, 5, 2), ("a", 9, 3)],
        # Far ahead: a watermark would drop everything below from here on.
        [("b", 10**9, 4), ("a", 10, 5), (None, 14, 6)],
        [("c", 3, 7), ("b", 10**9 + 9, 8), (None, 15, 9), ("a", 4, 10), ("c", 2, 11)],
        [("a", 20, 12), ("d", -5, 13), ("d", 4, 14), ("d", 5, 15)],
    ]
    for part in parts:
        spark.createDataFrame(part, "k string, at long, i long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = run_state(spark, tmp_path)
    assert got == [1, 2, 4, 5, 9, 11, 12, 13, 15]
