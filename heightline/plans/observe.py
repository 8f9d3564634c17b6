"""Metric and log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import logs, metrics
from . import inputs
from .registry import query

_LOGS = inputs.LOG_LINES_SQL
_MODE = "CASE WHEN event_type = 'view' THEN 'finalized' ELSE 'new_head' END"
DAY_S = 86_400


def _micros(ts):
    return F.unix_micros(F.col(ts).cast("timestamp"))


# --- counters ------------------------------------------------------------------


@query(
    "counter_by_label",
    f"""SELECT event_type AS component, {_MODE} AS reason, count(*) AS total
        FROM events GROUP BY ALL""",
)
def counter_by_label(spark, sf):
    rows = inputs.samples(spark, sf).select(
        F.col("event_type").alias("component"), F.expr(_MODE).alias("reason")
    )
    return metrics.count_by(rows, ["component", "reason"])


_CODE = "CASE WHEN value > 400 THEN 'timeout' WHEN value > 200 THEN 'network' ELSE 'rpc' END"
_REASON = "CASE WHEN value > 245 THEN 'dial' ELSE 'subscribe' END"


@query(
    "scanner_counters",
    f"""WITH s AS (SELECT *, {_MODE} AS mode, 'ethereum' AS chain, {_CODE} AS code,
                          {_REASON} AS reason FROM events)
        SELECT 'scanned' AS counter, chain, NULL AS code, mode, NULL AS reason, count(*) AS total
            FROM s WHERE event_type IN ('click', 'view', 'purchase') GROUP BY chain, mode
        UNION ALL SELECT 'reconnects', NULL, NULL, NULL, reason, count(*)
            FROM s WHERE event_type = 'signup' GROUP BY reason
        UNION ALL SELECT 'fetch_errors', NULL, code, mode, NULL, count(*)
            FROM s WHERE event_type = 'error' GROUP BY code, mode
        UNION ALL SELECT 'handler_errors', NULL, NULL, mode, NULL, count(*)
            FROM s WHERE event_type = 'error' AND value > 300 GROUP BY mode""",
)
def scanner_counters(spark, sf):
    rows = inputs.samples(spark, sf).select(
        "event_type",
        "value",
        F.expr(_MODE).alias("mode"),
        F.lit("ethereum").alias("chain"),
        F.expr(_CODE).alias("code"),
        F.expr(_REASON).alias("reason"),
    )
    failed = F.col("event_type") == "error"
    return metrics.count_many(
        rows,
        {
            "scanned": (F.col("event_type").isin("click", "view", "purchase"), ["mode", "chain"]),
            "reconnects": (F.col("event_type") == "signup", ["reason"]),
            "fetch_errors": (failed, ["mode", "code"]),
            "handler_errors": (failed & (F.col("value") > 300), ["mode"]),
        },
    )


@query(
    "publish_success_rate",
    """SELECT user_id, count(*) AS attempts, count(*) FILTER (WHERE event_type <> 'error') AS success,
            count(*) FILTER (WHERE event_type = 'error') AS errors,
            100.0::DOUBLE * count(*) FILTER (WHERE event_type <> 'error') / count(*) AS success_rate
       FROM events GROUP BY user_id""",
)
def publish_success_rate(spark, sf):
    ok = F.col("event_type") != "error"
    return metrics.publish_rate(inputs.samples(spark, sf), ok, ["user_id"])


def _histogram_sql(bounds, labels: str, value: str) -> str:
    lists = ", ".join(f"({float(b)}, '{b}')" for b in bounds) + ", ('infinity'::DOUBLE, '+Inf')"
    group = f"{labels}, " if labels else ""
    return f"""
        WITH s AS (SELECT *, {value} AS v, {_MODE} AS mode FROM events),
        t AS (SELECT {group} count(v) AS total_count, round(sum(v), 4) AS total_sum
              FROM s {'GROUP BY ' + labels if labels else ''}),
        b AS (SELECT CAST(bound AS DOUBLE) AS bound, le FROM (VALUES {lists}) x(bound, le)),
        c AS (SELECT {group} le, count(*) AS n FROM s JOIN b ON v <= bound GROUP BY {group} le)
        SELECT {', '.join('t.' + x.strip() for x in labels.split(',')) + ', ' if labels else ''}
               b.le, coalesce(n, 0) AS bucket_count, total_count, total_sum
        FROM t CROSS JOIN b LEFT JOIN c
          ON c.le = b.le {''.join(f' AND c.{x.strip()} = t.{x.strip()}' for x in labels.split(',')) if labels else ''}"""


@query("latency_histogram", _histogram_sql(metrics.END_TO_END_BOUNDS, "event_type", "value"))
def latency_histogram(spark, sf):
    made = metrics.histogram(
        inputs.samples(spark, sf), F.col("value"), metrics.END_TO_END_BOUNDS, ["event_type"]
    )
    return made.withColumn("total_sum", F.round("total_sum", 4))


@query("fetch_latency_histogram", _histogram_sql(metrics.LATENCY_BOUNDS, "mode", "value * 5"))
def fetch_latency_histogram(spark, sf):
    rows = inputs.samples(spark, sf).withColumn("mode", F.expr(_MODE))
    made = metrics.histogram(rows, F.col("value") * 5, metrics.LATENCY_BOUNDS, ["mode"])
    return made.withColumn("total_sum", F.round("total_sum", 4))


# --- gauges --------------------------------------------------------------------


@query(
    "gauge_last",
    """SELECT user_id, event_type, arg_max(value, ts) AS value, epoch_us(max(ts)) AS at_us,
            arg_max(value, ts) / 1024.0::DOUBLE / 1024.0::DOUBLE AS megabytes
       FROM events GROUP BY user_id, event_type""",
)
def gauge_last(spark, sf):
    last = metrics.gauge_last(
        inputs.samples(spark, sf), ["user_id", "event_type"], "ts", "value"
    )
    return last.select(
        "user_id",
        "event_type",
        "value",
        _micros("ts").alias("at_us"),
        metrics.rescaled(F.col("value"), 1024 * 1024).alias("megabytes"),
    )


@query(
    "avg_by_label",
    """SELECT event_type, round(avg(v), 6) AS average FROM (
            SELECT user_id, event_type, arg_max(value, ts) AS v FROM events
            GROUP BY user_id, event_type) GROUP BY event_type""",
)
def avg_by_label(spark, sf):
    made = metrics.average_by(
        inputs.samples(spark, sf), ["event_type"], ["user_id"], "ts", "value"
    )
    return made.withColumn("average", F.round("average", 6))


@query(
    "ratio_clamped",
    """SELECT user_id, 100.0::DOUBLE * used / greatest(total, 1) AS pct FROM (
            SELECT user_id, count(*) FILTER (WHERE value > 400) AS used,
                   count(*) FILTER (WHERE value > 300) AS total
            FROM events GROUP BY user_id)""",
)
def ratio_clamped(spark, sf):
    counted = (
        inputs.samples(spark, sf)
        .groupBy("user_id")
        .agg(
            F.count_if(F.col("value") > 400).alias("used"),
            F.count_if(F.col("value") > 300).alias("total"),
        )
    )
    return counted.select(
        "user_id", metrics.percent(F.col("used"), F.col("total")).alias("pct")
    )


# --- rates ---------------------------------------------------------------------

_RATE_SQL = f"""
    SELECT range_start, user_id, count(*) AS samples, coalesce(sum(
               CASE WHEN value < before THEN value ELSE value - before END), 0) AS increase
    FROM (SELECT date_trunc('day', ts) AS range_start, user_id, value,
                 lag(value) OVER (PARTITION BY date_trunc('day', ts), user_id
                                  ORDER BY ts, event_id) AS before
          FROM events)
    GROUP BY range_start, user_id"""


def _rates(spark, sf):
    return metrics.counter_rate(
        inputs.samples(spark, sf), ["user_id"], "ts", ["event_id"], "value", "1 day", DAY_S
    )


@query(
    "counter_rate",
    f"""SELECT epoch_us(range_start) AS range_start, user_id, samples,
            round(increase, 4) AS increase, round(increase / {DAY_S}.0::DOUBLE, 10) AS rate
        FROM ({_RATE_SQL})""",
)
def counter_rate(spark, sf):
    return _rates(spark, sf).select(
        _micros("range_start").alias("range_start"),
        "user_id",
        "samples",
        F.round("increase", 4).alias("increase"),
        F.round("rate", 10).alias("rate"),
    )


# --- rates at each step ----------------------------------------------------------

STEP_S = 3600
_STEPS = DAY_S // STEP_S


def _sliding_sql(counter: str) -> str:
    """Every sample in each of the ranges it lies in, for the checks."""
    return f"""
    SELECT s * {STEP_S} * 1000000 AS range_start, user_id, count(*) AS samples, coalesce(count_if(v < before), 0) AS resets,
           coalesce(sum(CASE WHEN v < before THEN v ELSE v - before END), 0) AS increase
    FROM (SELECT *, lag(v) OVER (PARTITION BY user_id, s ORDER BY ts, event_id) AS before
          FROM (SELECT ts, event_id, user_id, {counter} AS v,
                       unnest(range(CAST(floor(epoch(ts) / {STEP_S}) AS BIGINT) - {_STEPS - 1},
                                    CAST(floor(epoch(ts) / {STEP_S}) AS BIGINT) + 1)) AS s
                FROM events WHERE {counter} IS NOT NULL))
    GROUP BY s, user_id"""


def _sliding(spark, sf, counter):
    samples = inputs.samples(spark, sf).withColumn("value", counter)
    return metrics.sliding_rate(samples, ["user_id"], "ts", ["event_id"], "value", DAY_S, STEP_S)


@query(
    "rate_sliding",
    f"""SELECT range_start, user_id, samples, resets, round(increase, 4) AS increase,
            round(increase / {DAY_S}.0::DOUBLE, 9) AS rate
        FROM ({_sliding_sql('value')})""",
)
def rate_sliding(spark, sf):
    return _sliding(spark, sf, F.col("value")).select(
        _micros("range_start").alias("range_start"),
        "user_id",
        "samples",
        "resets",
        F.round("increase", 4).alias("increase"),
        F.round("rate", 9).alias("rate"),
    )


# Bytes of a container against what it may use, both counters, as a share at each step.
_USED, _LIMIT = "value", "97003.0::DOUBLE * (event_id % 97)"


@query(
    "rate_ratio",
    f"""SELECT a.range_start, a.user_id, round(100.0::DOUBLE * (a.increase / {DAY_S}.0::DOUBLE)
               / greatest(b.increase / {DAY_S}.0::DOUBLE, 1), 7) AS pct
        FROM ({_sliding_sql(_USED)}) a JOIN ({_sliding_sql(_LIMIT)}) b
          ON a.user_id = b.user_id AND a.range_start = b.range_start""",
)
def rate_ratio(spark, sf):
    used = _sliding(spark, sf, F.col("value"))
    limit = _sliding(spark, sf, F.expr("97003.0D * (event_id % 97)"))
    both = used.join(limit.select("user_id", "range_start", F.col("rate").alias("limit")), ["user_id", "range_start"])
    return both.select(
        _micros("range_start").alias("range_start"),
        "user_id",
        F.round(metrics.percent(F.col("rate"), F.col("limit")), 7).alias("pct"),
    )


# Two counters of each series, as a container has one for reads and one for writes.
_SENT = "CAST(event_id % 97 AS DOUBLE)"
_TWO_RATES_SQL = " UNION ALL ".join(
    f"""SELECT range_start, event_type, coalesce(sum(
               CASE WHEN {counter} < before THEN {counter} ELSE {counter} - before END), 0) AS increase
    FROM (SELECT date_trunc('day', ts) AS range_start, event_type, user_id, event_id, value,
                 lag({counter}) OVER (PARTITION BY date_trunc('day', ts), event_type, user_id
                                      ORDER BY ts, event_id) AS before
          FROM events)
    GROUP BY range_start, event_type, user_id"""
    for counter in ("value", _SENT)
)


@query(
    "rate_sum_by_label",
    f"""SELECT epoch_us(range_start) AS range_start, event_type,
            round(sum(increase / {DAY_S}.0::DOUBLE), 9) AS rate
        FROM ({_TWO_RATES_SQL}) GROUP BY range_start, event_type""",
)
def rate_sum_by_label(spark, sf):
    samples = inputs.samples(spark, sf)
    series = ["event_type", "user_id"]
    rates = [
        metrics.counter_rate(samples.withColumn("value", value), series, "ts", ["event_id"], "value", "1 day", DAY_S)
        for value in (F.col("value"), F.expr(_SENT))
    ]
    summed = metrics.sum_rates(rates[0].unionByName(rates[1]), ["range_start", "event_type"])
    return summed.select(
        _micros("range_start").alias("range_start"),
        "event_type",
        F.round("rate", 9).alias("rate"),
    )


@query(
    "throughput",
    """SELECT epoch_us(date_trunc('minute', ts)) AS window_start, count(*) AS total
       FROM events WHERE event_type = 'purchase' GROUP BY 1""",
)
def throughput(spark, sf):
    done = inputs.samples(spark, sf).filter(F.col("event_type") == "purchase")
    return metrics.throughput(done, "ts").withColumn("window_start", _micros("window_start"))


# --- labels --------------------------------------------------------------------


@query("label_values", "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL")
def label_values(spark, sf):
    return metrics.label_values(inputs.table(spark, sf, "documents"), "source")


@query(
    "label_select",
    """SELECT doc_id, source, lang FROM documents
       WHERE regexp_full_match(source, 'src(1|2)') AND regexp_full_match(lang, 'e.*')""",
)
def label_select(spark, sf):
    picked = metrics.select_labels(
        inputs.table(spark, sf, "documents"), {"source": "src(1|2)", "lang": "e.*"}
    )
    return picked.select("doc_id", "source", "lang")


# --- logs ----------------------------------------------------------------------


def _labelled(spark, sf):
    return logs.relabel(
        inputs.log_lines(spark, sf), "meta_container", logs.CONTAINER_PATTERN, "container"
    )


@query(
    "log_relabel",
    f"""SELECT event_id, substr(meta_container, 2) AS container, service AS compose_service,
            '/logs/' || substr(meta_container, 2) || '.json' AS path FROM ({_LOGS})""",
)
def log_relabel(spark, sf):
    rows = logs.copy_label(_labelled(spark, sf), "service", "compose_service")
    rows = logs.relabel(rows, "container", logs.LOG_PATH_PATTERN, "path", "/logs/$1.json")
    return rows.select("event_id", "container", "compose_service", "path")


@query(
    "log_drop",
    f"""SELECT event_id, substr(meta_container, 2) AS container FROM ({_LOGS})
        WHERE substr(meta_container, 2) <> 'promtail'""",
)
def log_drop(spark, sf):
    kept = logs.drop_matching(_labelled(spark, sf), "container", logs.DROPPED_CONTAINER)
    return kept.select("event_id", "container")


_MINE = f"regexp_full_match(service, '{inputs.SERVICE_PATTERN}')"


@query(
    "logfmt_extract",
    f"""SELECT event_id, service, CASE WHEN {_MINE} THEN instance END AS instance,
            CASE WHEN {_MINE} THEN service END AS log_service,
            CASE WHEN {_MINE} THEN instance END AS log_instance,
            CASE WHEN {_MINE} THEN level END AS log_level FROM ({_LOGS})""",
)
def logfmt_extract(spark, sf):
    # The instance is known from the line only, and only for matching services.
    lines = inputs.log_lines(spark, sf).drop("instance")
    found = logs.promote_labels(logs.extract_logfmt(lines, "line", "service", inputs.SERVICE_PATTERN))
    return found.select(
        "event_id", "service", "instance", "log_service", "log_instance", "log_level"
    )


@query(
    "log_lines_per_minute",
    f"""SELECT epoch_us(date_trunc('minute', ts)) AS window_start, instance, count(*) AS total
        FROM ({_LOGS}) GROUP BY 1, 2""",
)
def log_lines_per_minute(spark, sf):
    counted = metrics.throughput(inputs.log_lines(spark, sf), "ts", labels=["instance"])
    return counted.withColumn("window_start", _micros("window_start"))


@query(
    "log_lines_sliding",
    f"""SELECT s * 1000000 AS window_start, service, count(*) AS total FROM (
            SELECT service, unnest(range(CAST(floor(epoch(ts) / 5) AS BIGINT) * 5 - 55,
                                         CAST(floor(epoch(ts) / 5) AS BIGINT) * 5 + 5, 5)) AS s
            FROM ({_LOGS})) GROUP BY s, service""",
)
def log_lines_sliding(spark, sf):
    counted = metrics.sliding_count(inputs.log_lines(spark, sf), "ts", 60, 5, ["service"])
    return counted.withColumn("window_start", _micros("window_start"))


@query(
    "log_select",
    f"""SELECT event_id, epoch_us(ts) AS at_us, instance FROM ({_LOGS})
        WHERE service = 'scanner' AND regexp_full_match(instance, 'replica1.*')
          AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'""",
)
def log_select(spark, sf):
    picked = logs.select_logs(
        inputs.log_lines(spark, sf),
        "ts",
        F.lit("2024-01-05").cast("timestamp_ntz"),
        F.lit("2024-01-25").cast("timestamp_ntz"),
        "scanner",
        "replica1.*",
    )
    return picked.select("event_id", _micros("ts").alias("at_us"), "instance")
