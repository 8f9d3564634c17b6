"""The test tables read as blocks, messages, samples and log lines.

Every function here is a projection of one whole table. The ``*_SQL`` texts are
the same projections for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sources.tables import spread

# Fixed parameters of the checks.
NOW_US = 1706659200000000  # 2024-01-31 00:00:00 UTC, after the last event
NOW_MS = NOW_US // 1000
DAY_US = 86_400_000_000
DAY_MS = 86_400_000
CONFIRMATIONS = 64

# Rows a task takes when they become blocks or messages.
ORDERS_A_TASK = 100_000
DOCUMENTS_A_TASK = 10_000
EVENTS_A_TASK = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- blocks ----------------------------------------------------------------


def heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as heads: chain, number, arrived (seconds), ok."""
    return as_heads(table(spark, sf_dir, "orders"))


def as_heads(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderstatus").alias("chain"),
        F.col("o_orderkey").alias("number"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("arrived"),
        (F.col("o_orderpriority") != "1-URGENT").alias("ok"),
    )


HEADS_SQL = """
    SELECT o_orderstatus AS chain, o_orderkey AS number,
           CAST(epoch(o_orderdate) AS BIGINT) AS arrived,
           o_orderpriority <> '1-URGENT' AS ok
    FROM orders"""


def raw_header(fields: dict[str, str]) -> str:
    """SQL of a raw header struct; fields not named are NULL of their type."""
    parts = [
        f"'{f.name}', CAST({fields.get(f.name, 'NULL')} AS {f.dataType.simpleString()})"
        for f in schemas.HEADER.fields
    ]
    return f"named_struct({', '.join(parts)})"


_ORDER_HEADER = raw_header(
    {
        "parentHash": "concat('0X', upper(sha2(cast(o_orderkey - 1 as string), 256)))",
        "coinbase": "concat('0x', substring(sha2(cast(o_custkey as string), 256), 25, 40))",
        "bloom": "CASE WHEN o_orderpriority = '1-URGENT' "
        "THEN concat('0x', repeat(sha2(cast(o_orderkey as string), 256), 8)) ELSE '0xbad' END",
        "difficulty": "cast(cast(floor(o_totalprice) as bigint) as string)",
        "number": "o_orderkey",
        "gasLimit": "CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 30000000 END",
        "gasUsed": "cast(floor(o_totalprice) as bigint)",
        "time": "unix_seconds(cast(o_orderdate as timestamp))",
        "extra": "concat(' 0x', hex(encode(o_orderpriority, 'UTF-8')))",
        "nonce": "concat('0x', lpad(hex(o_custkey), 8, '0'))",
        "baseFee": "CASE WHEN o_orderstatus <> 'P' "
        "THEN concat('0x', lpad(hex(o_custkey), 8, '0')) END",
        "withdrawalsHash": "''",
        "parentBeaconRoot": "CASE WHEN o_orderstatus = 'F' THEN '0x1' END",
        "blobGasUsed": "CASE WHEN o_orderstatus = 'F' THEN 0 END",
    }
)


def order_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw blocks without nested lists."""
    raw = f"""named_struct(
        'hash', concat('0x', sha2(cast(o_orderkey as string), 256)),
        'header', {_ORDER_HEADER},
        'uncles', cast(array() as array<struct<{_ddl(schemas.HEADER)}>>),
        'transactions', cast(NULL as array<struct<{_ddl(schemas.TRANSACTION)}>>),
        'withdrawals', cast(array() as array<struct<{_ddl(schemas.WITHDRAWAL)}>>))"""
    return spread(table(spark, sf_dir, "orders"), ORDERS_A_TASK).select(
        F.col("o_orderstatus").alias("chain"),
        F.col("o_orderkey").alias("number"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("arrived"),
        F.expr(raw).alias("raw"),
    )


def _ddl(struct) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in struct.fields)


# Canonical fields of order blocks, for the checks.
ORDER_BLOCKS_SQL = """
    SELECT o_orderstatus AS chain, o_orderkey AS number,
           CAST(epoch(o_orderdate) AS BIGINT) AS arrived,
           '0x' || sha256(CAST(o_orderkey AS VARCHAR)) AS hash,
           '0x' || sha256(CAST(o_orderkey - 1 AS VARCHAR)) AS parent_hash,
           '0x' || substr(sha256(CAST(o_custkey AS VARCHAR)), 25, 40) AS coinbase,
           CASE WHEN o_orderpriority = '1-URGENT'
                THEN '0x' || repeat(sha256(CAST(o_orderkey AS VARCHAR)), 8)
                ELSE '0x' || repeat('0', 512) END AS bloom,
           CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS difficulty,
           CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 30000000 END AS gas_limit,
           CAST(floor(o_totalprice) AS BIGINT) AS gas_used,
           '0x' || lower(hex(encode(o_orderpriority))) AS extra,
           '0x' || rpad(lpad(lower(hex(o_custkey)), 8, '0'), 16, '0') AS nonce,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS base_fee,
           CASE WHEN o_orderstatus = 'F' THEN '0x' || repeat('0', 63) || '1' END AS beacon_root,
           CASE WHEN o_orderstatus = 'F' THEN 0 END AS blob_gas_used
    FROM orders"""

_LINE_HEADER = raw_header(
    {
        "parentHash": "concat('0x', sha2(line, 256))",
        "number": "octet_length(line)",
        "gasUsed": "octet_length(line) * 21",
        "extra": "concat('0x', hex(encode(line, 'UTF-8')))",
    }
)
_DOCUMENT_HEADER = raw_header({"number": "doc_id", "gasUsed": "n_chars"})


def document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw blocks whose lines are transactions, uncles and withdrawals.

    A document is one record already, so no row has to gather others.
    """
    to_tx = """transform(_lines, (line, i) -> named_struct(
        'hash', concat('0X', upper(sha2(line, 256))),
        'type', CASE WHEN octet_length(line) > 160 THEN 2 WHEN octet_length(line) > 80 THEN 1 ELSE 0 END,
        'to', CASE WHEN octet_length(line) > 80 THEN concat('0x', substring(sha2(line, 256), 25, 40)) ELSE '' END,
        'value', concat(' ', cast(octet_length(line) * 1000000007L as string)),
        'gas', cast(octet_length(line) * 16 + 21000 as decimal(20,0)),
        'gasPrice', concat('0x', lpad(hex(octet_length(line)), 8, '0')),
        'maxFeePerGas', cast(NULL as string),
        'maxPriorityFeePerGas', cast(NULL as string),
        'nonce', cast(i as decimal(20,0)),
        'data', hex(encode(line, 'UTF-8')),
        'accessList', slice(array(
            named_struct('address', substring(sha2(line, 256), 1, 40), 'storageKeys', array('0xabc', sha2(line, 256))),
            named_struct('address', substring(sha2(line, 256), 21, 40), 'storageKeys', cast(array() as array<string>)),
            named_struct('address', '', 'storageKeys', array(sha2(line, 256)))), 1, least(3, octet_length(line) div 120)),
        'chainId', '1'))"""
    to_uncle = f"transform(_lines, line -> {_LINE_HEADER})"
    to_withdrawal = """transform(_lines, (line, i) -> CASE WHEN line <> '' THEN named_struct(
        'index', cast(i as decimal(20,0)),
        'validator', cast(octet_length(line) as decimal(20,0)),
        'address', concat('0x', substring(sha2(line, 256), 25, 40)),
        'amount', cast(octet_length(line) * 32 as decimal(20,0))) END)"""
    return (
        spread(table(spark, sf_dir, "documents"), DOCUMENTS_A_TASK)
        .withColumn("_lines", F.expr("split(text, '\\n', -1)"))
        .select(
            "doc_id",
            F.expr(
                f"""named_struct(
                'hash', concat('0x', sha2(cast(doc_id as string), 256)),
                'header', {_DOCUMENT_HEADER},
                'uncles', {to_uncle},
                'transactions', {to_tx},
                'withdrawals', {to_withdrawal})"""
            ).alias("raw"),
        )
    )


LINES_SQL = """
    SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)"""


# --- messages ----------------------------------------------------------------


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as outbox entries: id, hash, at_us (microseconds), kind, scanned_at_ms."""
    return as_entries(table(spark, sf_dir, "events"))


def as_entries(events: DataFrame) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        F.concat(ms.cast("string"), F.lit("-"), F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("0x"), F.sha2(F.col("user_id").cast("string"), 256)).alias("hash"),
        us.alias("at_us"),
        F.col("event_type").alias("kind"),
        "event_id",
        "user_id",
        "value",
        "props",
    )


ENTRIES_SQL = """
    SELECT CAST(epoch_us(ts) // 1000 AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) AS id,
           '0x' || sha256(CAST(user_id AS VARCHAR)) AS hash,
           epoch_us(ts) AS at_us, epoch_us(ts) // 1000 AS at_ms, event_type AS kind, event_id, user_id, value, props
    FROM events"""

# Heights that need all 64 bits.
_WIDE = "WHEN k = 97 THEN '9223372036854775808' WHEN k = 98 THEN '18446744073709551615'"
_MESSAGE_FIELDS = {
    "hash": """CASE WHEN k < 5 THEN NULL WHEN k < 10 THEN '' ELSE hash END""",
    "number": f"""CASE {_WIDE} WHEN k >= 10 AND k < 15 THEN NULL WHEN k >= 15 AND k < 20 THEN ''
        WHEN k >= 20 AND k < 23 THEN 'x' WHEN k >= 23 AND k < 25 THEN '18446744073709551616'
        ELSE CAST(event_id AS {{string}}) END""",
    "payload": """CASE WHEN k >= 25 AND k < 30 THEN NULL WHEN k >= 30 AND k < 35 THEN ''
        WHEN k = 35 THEN '{{' WHEN k = 36 THEN '{{"header":{{"number":7}}}}garbage'
        WHEN k = 37 THEN '{{"hash":5}}' WHEN k = 38 THEN '{{"header":{{"gasLimit":"5"}}}}'
        WHEN k = 39 THEN '{{"header":{{"gasUsed":-5}}}}'
        WHEN k < 60 THEN '{{"header":{{"number":0}}}}'
        ELSE '{{"hash":"' || hash || '","header":{{"number":'
            || CASE WHEN k = 97 THEN '9223372036854775808' WHEN k = 98 THEN '18446744073709551615'
                    ELSE CAST(event_id + 1 AS {string}) END || '}}}}'
        END""",
}


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as outbox messages, sound or broken as their property ``k`` says."""
    return as_messages(spread(table(spark, sf_dir, "events"), EVENTS_A_TASK))


def as_messages(events: DataFrame) -> DataFrame:
    base = as_entries(events).withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    return base.select(
        "id",
        *[F.expr(sql.format(string="STRING")).alias(c) for c, sql in _MESSAGE_FIELDS.items()],
        F.expr("cast(at_us div 1000 as string)").alias("scanned_at_ms"),
        "at_us",
        "event_id",
    )


_M = {c: sql.format(string="VARCHAR") for c, sql in _MESSAGE_FIELDS.items()}
MESSAGES_SQL = f"""
    SELECT id, {_M['hash']} AS hash, {_M['number']} AS number, {_M['payload']} AS payload,
           CAST(at_ms AS VARCHAR) AS scanned_at_ms, at_us, event_id, hash AS sent_hash, k
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
          FROM ({ENTRIES_SQL}))"""


# The height of a sound message as text: the message's own where the payload has none.
REPAIRED_NUMBER_SQL = f"CASE WHEN k < 60 THEN CAST(event_id AS VARCHAR) {_WIDE} ELSE CAST(event_id + 1 AS VARCHAR) END"


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as published markers: hash, published_at_us (microseconds)."""
    return (
        entries(spark, sf_dir)
        .filter(F.col("kind") == "purchase")
        .select("hash", F.col("at_us").alias("published_at"))
    )


LEDGER_SQL = f"""
    SELECT hash, at_us AS published_at FROM ({ENTRIES_SQL}) WHERE kind = 'purchase'"""


# --- samples and logs --------------------------------------------------------


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metric samples; ``ts`` stays as stored, so that filters on it reach the scan."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
    )


# Services whose lines are logfmt.
SERVICE_PATTERN = "scanner(-replica[0-9]+)?"
LEVELS = {"error": "ERROR", "signup": "WARN"}
SERVICES = {
    "click": "scanner",
    "view": "scanner-replica1",
    "purchase": "scanner-replica2",
    "error": "scanner-service",
    "signup": "kafka",
}
_SERVICE = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in SERVICES.items()
) + " END"
_LEVEL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in LEVELS.items()
) + " ELSE 'INFO' END"
_CONTAINER = "CASE WHEN event_type = 'signup' THEN '/promtail' ELSE '/' || ({service}) END"


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as container log lines with discovered labels."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.expr(_CONTAINER.format(service=_SERVICE)).alias("meta_container"),
        F.expr(_SERVICE).alias("service"),
        F.expr("concat('replica', cast(user_id as string))").alias("instance"),
        F.expr(
            f"""concat('time=', cast(event_id as string), ' level=', {_LEVEL},
            ' msg="user said level=none and \\\\"left\\\\"" service="', {_SERVICE},
            '" instance=replica', cast(user_id as string), ' err=', props)"""
        ).alias("line"),
    )


LOG_LINES_SQL = f"""
    SELECT event_id, ts, {_CONTAINER.format(service=_SERVICE)} AS meta_container,
           {_SERVICE} AS service, 'replica' || CAST(user_id AS VARCHAR) AS instance,
           {_LEVEL} AS level
    FROM events"""


# Of each hundred entries a few have lost their end, their wrapping, or a field.
_CUT, _BARE, _NO_TIME = "k % 20 = 3", "k % 20 = 7", "k % 20 = 11"


def docker_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as a container runtime writes them, in JSON objects: at_us, container, entry."""
    events = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    lines = log_lines(spark, sf_dir).join(events, "event_id")
    time = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    body = F.replace(F.replace("line", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    entry = F.concat(F.lit('{"log":"'), body, F.lit('\\n","stream":"stdout","time":"'), time, F.lit('"}'))
    return lines.select(
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"),
        F.substring("meta_container", 2, 99).alias("container"),
        F.when(F.expr(_CUT), F.substring(entry, 1, 40))
        .when(F.expr(_BARE), F.col("line"))
        .when(F.expr(_NO_TIME), F.replace(entry, F.lit('"time"'), F.lit('"tome"')))
        .otherwise(entry)
        .alias("entry"),
    )


def containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What discovery knows of the containers that log: id, name, service, project."""
    return log_lines(spark, sf_dir).groupBy(F.substring("meta_container", 2, 99).alias("id")).agg(
        F.first("meta_container").alias("name"), F.first("service").alias("service"), F.lit("blocks").alias("project")
    )
