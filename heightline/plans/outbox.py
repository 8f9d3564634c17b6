"""Outbox, dedup, publishing and backlog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bigints, hexes, ids
from ..functions.hexes import ZERO_ADDRESS, ZERO_BLOOM, ZERO_HASH, ZERO_NONCE
from ..operators import backlog, contract, dedup, markers, records
from ..sources.tables import outbox_messages
from ..streaming.publish import PublishPlan, publish_once
from . import inputs
from .chain import PAYLOAD_SQL, mapped
from .registry import query

_ENTRIES = inputs.ENTRIES_SQL
_MESSAGES = inputs.MESSAGES_SQL
_LEDGER = inputs.LEDGER_SQL
NOW, DAY = inputs.NOW_US, inputs.DAY_US
NOW_MS, DAY_MS = inputs.NOW_MS, inputs.DAY_MS
TOPIC = "blocks"
STREAM_KEY = "{blocks}:stream"
BATCH = 100
SIZE_LIMIT = 4096
PAGE_CURSOR = "1705000000000-0"


# --- outbox and records --------------------------------------------------------


@query(
    "outbox_message",
    f"""SELECT CAST(arrived * 1000 AS VARCHAR) || '-' || CAST(number AS VARCHAR) AS id, hash,
            CAST(number AS VARCHAR) AS number, payload,
            CAST(arrived * 1000 AS VARCHAR) AS scanned_at_ms
        FROM ({PAYLOAD_SQL})""",
)
def outbox_message(spark, sf):
    blocks = mapped(inputs.order_blocks(spark, sf))
    ms = F.col("arrived") * 1000
    message_id = F.concat(ms.cast("string"), F.lit("-"), F.col("number").cast("string"))
    return outbox_messages(blocks, message_id, ms)


@query(
    "kafka_record",
    f"""SELECT '{TOPIC}' AS topic, upper(substr(hash, 3)) AS key_hex, payload AS value,
            'block-number=' || CAST(number AS VARCHAR) || ';block-hash=' || hash
            || ';source-message-id=' || CAST(arrived AS VARCHAR) || '-0' AS headers
        FROM ({PAYLOAD_SQL})""",
)
def kafka_record(spark, sf):
    blocks = mapped(inputs.order_blocks(spark, sf))
    message_id = F.concat(F.col("arrived").cast("string"), F.lit("-0"))
    extras = F.concat(
        records.source_header(message_id), F.array(records.header("", F.lit("nameless")))
    )
    made = records.block_records(blocks, TOPIC, extras=extras)
    shown = F.transform(
        F.col("headers"), lambda h: F.concat(h["key"], F.lit("="), F.decode(h["value"], "UTF-8"))
    )
    return made.select(
        "topic",
        F.hex("key").alias("key_hex"),
        F.decode("value", "UTF-8").alias("value"),
        F.array_join(shown, ";").alias("headers"),
    )


@query(
    "latest_per_key",
    f"""SELECT hash, id, kind, value FROM (
            SELECT *, row_number() OVER (PARTITION BY hash ORDER BY at_us DESC, event_id DESC) AS r
            FROM ({_ENTRIES})) WHERE r = 1""",
)
def latest_per_key(spark, sf):
    newest = dedup.latest_per_key(inputs.entries(spark, sf), ["hash"], ["at_us", "event_id"])
    return newest.select("hash", "id", "kind", "value")


# --- contract --------------------------------------------------------------------


@query(
    "message_contract",
    f"""SELECT id, CASE
            WHEN hash IS NULL THEN 'hash_missing' WHEN hash = '' THEN 'hash_empty'
            WHEN number IS NULL THEN 'number_missing' WHEN number = '' THEN 'number_empty'
            WHEN NOT regexp_full_match(number, '[0-9]+')
                 OR TRY_CAST(number AS UBIGINT) IS NULL THEN 'number_invalid'
            WHEN payload IS NULL THEN 'payload_missing' WHEN payload = '' THEN 'payload_empty'
            WHEN NOT json_valid(payload) THEN 'payload_undecodable'
            WHEN json_type(payload, '$.hash') <> 'VARCHAR' OR json_type(payload, '$.header.gasLimit') <> 'UBIGINT'
                 OR json_type(payload, '$.header.gasUsed') <> 'UBIGINT' THEN 'payload_undecodable' END AS reason
        FROM ({_MESSAGES})""",
)
def message_contract(spark, sf):
    return contract.check_messages(inputs.messages(spark, sf)).select("id", "reason")


@query(
    "size_guard",
    f"""SELECT doc_id, CAST(octet_length(encode(text)) AS INTEGER) AS value_bytes,
            octet_length(encode(text)) > {SIZE_LIMIT} AS rejected FROM documents""",
)
def size_guard(spark, sf):
    documents = inputs.table(spark, sf, "documents")
    return contract.size_guard(documents, "text", SIZE_LIMIT).select(
        "doc_id", "value_bytes", "rejected"
    )


# --- dedup and markers -----------------------------------------------------------


@query(
    "dedup_first",
    f"""SELECT hash, id, kind, value FROM (
            SELECT *, row_number() OVER (PARTITION BY hash ORDER BY at_us, event_id) AS r
            FROM ({_ENTRIES})) WHERE r = 1""",
)
def dedup_first(spark, sf):
    first = dedup.first_arrival(inputs.entries(spark, sf), ["hash"], ["at_us", "event_id"])
    return first.select("hash", "id", "kind", "value")


DEDUP_TTL_SQL = f"""
    WITH RECURSIVE e AS (
        SELECT event_id, user_id, epoch_us(ts) AS at_us,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
        FROM events),
    walk AS (
        SELECT event_id, user_id, n, at_us AS accepted, TRUE AS keep FROM e WHERE n = 1
        UNION ALL
        SELECT e.event_id, e.user_id, e.n,
               CASE WHEN e.at_us >= w.accepted + {DAY} THEN e.at_us ELSE w.accepted END,
               e.at_us >= w.accepted + {DAY}
        FROM walk w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1)
    SELECT user_id, event_id, accepted AS at_us FROM walk WHERE keep"""


@query("dedup_ttl", DEDUP_TTL_SQL)
def dedup_ttl(spark, sf):
    rows = inputs.entries(spark, sf).select("user_id", "event_id", "at_us")
    return dedup.dedup_ttl(rows, "user_id", "at_us", DAY, ["event_id"])


DEDUP_HOT_SQL = DEDUP_TTL_SQL.replace("user_id", "event_type")


@query("dedup_ttl_hot", DEDUP_HOT_SQL)
def dedup_ttl_hot(spark, sf):
    # A handful of keys that share all rows, each cut over several tasks.
    rows = inputs.entries(spark, sf).select(F.col("kind").alias("event_type"), "event_id", "at_us")
    return dedup.dedup_ttl(rows, "event_type", "at_us", DAY, ["event_id"], floor=0)


@query(
    "marker_insert",
    f"""WITH c AS (
            SELECT CASE WHEN kind = 'error' THEN ' ' ELSE hash END AS hash, at_us, event_id
            FROM ({_ENTRIES}) WHERE kind <> 'purchase'),
        live AS (SELECT hash FROM ({_LEDGER}) WHERE published_at > {NOW} - {7 * DAY})
        SELECT hash, at_us, event_id FROM (
            SELECT *, row_number() OVER (PARTITION BY hash ORDER BY at_us, event_id) AS r
            FROM c WHERE trim(hash) <> '' AND hash NOT IN (SELECT hash FROM live))
        WHERE r = 1""",
)
def marker_insert(spark, sf):
    seen = inputs.entries(spark, sf).filter(F.col("kind") != "purchase")
    candidates = seen.select(
        F.when(F.col("kind") == "error", F.lit(" ")).otherwise(F.col("hash")).alias("hash"),
        "at_us",
        "event_id",
    )
    live = markers.live_markers(inputs.ledger(spark, sf), "published_at", 7 * DAY, NOW)
    return markers.insert_markers(candidates, live, "hash", ["at_us", "event_id"])


@query(
    "marker_lookup",
    f"""SELECT id, hash IN (SELECT hash FROM ({_LEDGER}) WHERE published_at > {NOW} - {7 * DAY})
            AS published FROM ({_ENTRIES})""",
)
def marker_lookup(spark, sf):
    live = markers.live_markers(inputs.ledger(spark, sf), "published_at", 7 * DAY, NOW)
    return markers.look_up_markers(inputs.entries(spark, sf), live, "hash").select(
        "id", "published"
    )


@query(
    "marker_live",
    f"SELECT hash, published_at FROM ({_LEDGER}) WHERE published_at > {NOW} - {DAY}",
)
def marker_live(spark, sf):
    return markers.live_markers(inputs.ledger(spark, sf), "published_at", DAY, NOW)


@query(
    "publish_anti_join",
    f"""SELECT id, hash FROM ({_ENTRIES}) WHERE kind <> 'purchase' AND hash NOT IN (
            SELECT hash FROM ({_LEDGER}) WHERE published_at > {NOW} - {DAY})""",
)
def publish_anti_join(spark, sf):
    waiting = inputs.entries(spark, sf).filter(F.col("kind") != "purchase")
    live = markers.live_markers(inputs.ledger(spark, sf), "published_at", DAY, NOW)
    return markers.skip_published(waiting, live, "hash").select("id", "hash")


_BARE_HEADER = (
    f'{{"parentHash":"{ZERO_HASH}","uncleHash":"{ZERO_HASH}","coinbase":"{ZERO_ADDRESS}",'
    f'"root":"{ZERO_HASH}","txHash":"{ZERO_HASH}","receiptHash":"{ZERO_HASH}","bloom":"{ZERO_BLOOM}"'
)
PUBLISH_ONCE_SQL = f"""
    WITH sound AS (
        SELECT id, sent_hash AS hash, at_us, event_id,
               {inputs.REPAIRED_NUMBER_SQL} AS number
        FROM ({_MESSAGES}) WHERE k >= 40),
    live AS (SELECT hash FROM ({_LEDGER}) WHERE published_at > {NOW} - {DAY})
    SELECT id, upper(substr(hash, 3)) AS key_hex, number,
           '{{"hash":"' || hash || '","header":{_BARE_HEADER},"number":' || CAST(number AS VARCHAR)
           || ',"mixDigest":"{ZERO_HASH}","nonce":"{ZERO_NONCE}"}}}}' AS value
    FROM (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY at_us, event_id) AS r
          FROM sound WHERE hash NOT IN (SELECT hash FROM live))
    WHERE r = 1"""
PUBLISH = PublishPlan(topic=TOPIC, max_record_bytes=20 * 1024 * 1024, marker_ttl=DAY)


@query("publish_once", PUBLISH_ONCE_SQL)
def publish_once_query(spark, sf):
    made = publish_once(
        inputs.messages(spark, sf), inputs.ledger(spark, sf), PUBLISH, NOW, ["at_us", "event_id"]
    )
    return made.select(
        "id",
        F.hex("key").alias("key_hex"),
        F.col("block.header.number").cast("string").alias("number"),
        F.decode("value", "UTF-8").alias("value"),
    )


# --- backlog ---------------------------------------------------------------------

# Signups were never delivered, purchases were acknowledged, the rest is pending.
_DELIVERED = "kind <> 'signup'"


def _delivered(spark, sf):
    return inputs.entries(spark, sf).filter(F.col("kind") != "signup")


def _acked(spark, sf):
    return inputs.entries(spark, sf).filter(F.col("kind") == "purchase")


def _pending(spark, sf):
    return backlog.pending(_delivered(spark, sf), _acked(spark, sf))


_PENDING_SQL = f"""SELECT * FROM ({_ENTRIES}) WHERE {_DELIVERED} AND id NOT IN (
    SELECT id FROM ({_ENTRIES}) WHERE kind = 'purchase')"""


@query("pending_entries", f"SELECT id, hash, kind FROM ({_PENDING_SQL})")
def pending_entries(spark, sf):
    return _pending(spark, sf).select("id", "hash", "kind")


@query(
    "stale_reclaim",
    f"""SELECT id, {NOW_MS} - at_ms AS idle_ms, 'replica1' AS claimed_by FROM ({_PENDING_SQL})
        WHERE {NOW_MS} - at_ms >= {DAY_MS}""",
)
def stale_reclaim(spark, sf):
    waiting = _pending(spark, sf).withColumn("delivered_ms", F.expr("at_us div 1000"))
    return backlog.reclaim_stale(waiting, "delivered_ms", NOW_MS, DAY_MS, "replica1").select(
        "id", "idle_ms", "claimed_by"
    )


@query(
    "work_list",
    f"""WITH p AS ({_PENDING_SQL}), all_phases AS (
            SELECT id, 0 AS turn FROM p WHERE kind = 'click'
            UNION ALL SELECT id, 1 FROM p WHERE {NOW_MS} - at_ms >= {DAY_MS}
            UNION ALL SELECT id, 2 FROM ({_ENTRIES}) WHERE kind = 'signup')
        SELECT id, CASE min(turn) WHEN 0 THEN 'pending' WHEN 1 THEN 'reclaimed' ELSE 'new' END AS phase
        FROM all_phases GROUP BY id""",
)
def work_list(spark, sf):
    kind = F.col("kind")
    states = backlog.entry_states(
        inputs.entries(spark, sf),
        {
            backlog.DELIVERED: kind != "signup",
            backlog.ACKED: kind == "purchase",
            backlog.OWN: kind == "click",
            backlog.STALE: F.expr("at_us div 1000") <= NOW_MS - DAY_MS,
            backlog.NEW: kind == "signup",
        },
    )
    return backlog.phases(states)


@query(
    "oldest_n",
    f"SELECT id, hash FROM ({_ENTRIES}) WHERE kind = 'signup' ORDER BY at_ms, event_id LIMIT {BATCH}",
)
def oldest_n(spark, sf):
    waiting = inputs.entries(spark, sf).filter(F.col("kind") == "signup")
    return backlog.oldest(waiting, BATCH).select("id", "hash")


_CURSOR_MS = PAGE_CURSOR.split("-")[0]


@query(
    "page_after",
    f"""SELECT id, hash FROM ({_PENDING_SQL})
        WHERE at_ms > {_CURSOR_MS} OR (at_ms = {_CURSOR_MS} AND event_id > 0)
        ORDER BY at_ms, event_id LIMIT {BATCH}""",
)
def page_after(spark, sf):
    return backlog.page_after(_pending(spark, sf), PAGE_CURSOR, BATCH).select("id", "hash")


@query(
    "backlog_summary",
    f"""SELECT count(*) AS stream_length,
            count(*) FILTER (WHERE {_DELIVERED} AND kind <> 'purchase') AS pending,
            coalesce(greatest(0, {NOW_MS} - min(
                CASE WHEN {_DELIVERED} AND kind <> 'purchase' THEN at_ms END)), 0)
                AS oldest_pending_age_ms,
            count(*) FILTER (WHERE kind = 'signup') AS lag
        FROM ({_ENTRIES})""",
)
def backlog_summary(spark, sf):
    return backlog.backlog_summary(
        inputs.entries(spark, sf),
        F.col("kind") != "signup",
        F.col("kind") == "purchase",
        NOW_MS,
    )


# --- scalar functions --------------------------------------------------------------


@query(
    "trim_0x",
    f"""SELECT event_id, sha256(CAST(user_id AS VARCHAR)) AS bare, lower(kind) AS word
        FROM ({_ENTRIES})""",
)
def trim_0x(spark, sf):
    rows = inputs.entries(spark, sf)
    padded = F.concat(F.lit(" \t"), F.regexp_replace(F.upper("hash"), "^0X", "0X"), F.lit("\n "))
    return rows.withColumn("padded", padded).select(
        "event_id",
        F.expr(hexes.trim_0x("padded")).alias("bare"),
        F.expr(hexes.trim_0x("concat(initcap(kind), ' ')")).alias("word"),
    )


# Decimal, padded decimal, hex of one, eight and fourteen bytes, odd hex, bad text.
@query(
    "big_parse",
    f"""SELECT event_id, CASE
            WHEN k < 20 THEN CAST(event_id AS VARCHAR)
            WHEN k < 30 THEN '-' || CAST(event_id + 1 AS VARCHAR)
            WHEN k < 70 THEN CAST(list_reduce(list_prepend(0::HUGEINT, list_transform(
                string_split(CASE WHEN k < 50 THEN substr(hash, 3, 16) ELSE substr(hash, 3, 30) END, ''),
                lambda c: CAST(strpos('0123456789abcdef', c) - 1 AS HUGEINT))),
                lambda a, b: a * 16::HUGEINT + b) AS VARCHAR)
            WHEN k < 80 THEN '0' END AS big
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
              FROM ({_ENTRIES}))""",
)
def big_parse(spark, sf):
    rows = inputs.entries(spark, sf).withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    number = F.col("event_id").cast("string")
    text = (
        F.when(F.col("k") < 20, F.concat(F.lit(" +00"), number, F.lit(" ")))
        .when(F.col("k") < 30, F.concat(F.lit("-0"), (F.col("event_id") + 1).cast("string")))
        # The leading 0x keeps digits-only hashes from reading as decimal.
        .when(F.col("k") < 50, F.concat(F.lit("0x"), F.substring("hash", 3, 16)))
        .when(F.col("k") < 70, F.concat(F.lit("0X"), F.upper(F.substring("hash", 3, 30))))
        .when(F.col("k") < 80, F.lit("0x"))
        .when(F.col("k") < 90, F.concat(F.lit("0x"), F.substring("hash", 3, 15)))
        .otherwise(F.concat(F.lit("z"), number))
    )
    return rows.withColumn("text", text).select(
        "event_id", F.expr(bigints.parse_big("text")).alias("big")
    )


@query(
    "bytes_hex",
    """SELECT doc_id, CASE WHEN text <> '' THEN '0x' || lower(hex(encode(text))) END AS hex
       FROM documents""",
)
def bytes_hex(spark, sf):
    return inputs.table(spark, sf, "documents").select(
        "doc_id", F.expr(hexes.bytes_hex("encode(text, 'UTF-8')")).alias("hex")
    )


@query(
    "hex_bytes",
    f"""SELECT event_id, CASE WHEN kind = 'error' OR kind = 'signup' THEN NULL
            ELSE upper(substr(hash, 3)) END AS bytes_hex FROM ({_ENTRIES})""",
)
def hex_bytes(spark, sf):
    rows = inputs.entries(spark, sf)
    text = (
        F.when(F.col("kind") == "error", F.substring("hash", 1, 65))
        .when(F.col("kind") == "signup", F.concat(F.col("hash"), F.lit("zz")))
        .otherwise(F.concat(F.lit(" "), F.upper("hash")))
    )
    return rows.withColumn("text", text).select(
        "event_id", F.expr(f"hex({hexes.hex_bytes('text')})").alias("bytes_hex")
    )


@query(
    "stream_id_millis",
    f"""SELECT event_id, CASE WHEN kind = 'error' OR kind = 'signup' THEN NULL ELSE at_ms END AS ms
        FROM ({_ENTRIES})""",
)
def stream_id_millis(spark, sf):
    rows = inputs.entries(spark, sf)
    text = (
        F.when(F.col("kind") == "error", F.substring_index("id", "-", 1))
        .when(F.col("kind") == "signup", F.concat(F.lit("-"), F.col("id")))
        .otherwise(F.col("id"))
    )
    return rows.select("event_id", ids.stream_id_millis(text).alias("ms"))


@query(
    "scanned_at",
    f"""SELECT event_id, CASE WHEN kind = 'error' THEN NULL ELSE at_ms END AS scanned_at
        FROM ({_ENTRIES})""",
)
def scanned_at(spark, sf):
    rows = inputs.entries(spark, sf)
    ms = F.substring_index("id", "-", 1)
    text = F.when(F.col("kind") == "error", F.concat(F.lit(" "), ms)).otherwise(ms)
    return rows.select("event_id", ids.scanned_at_millis(text).alias("scanned_at"))


@query(
    "e2e_latency",
    f"""SELECT event_id, greatest(0, {NOW_MS - 15 * DAY_MS} - at_ms) AS latency_ms
        FROM ({_ENTRIES})""",
)
def e2e_latency(spark, sf):
    scanned = ids.scanned_at_millis(F.substring_index("id", "-", 1))
    return inputs.entries(spark, sf).select(
        "event_id", ids.latency_millis(scanned, NOW_MS - 15 * DAY_MS).alias("latency_ms")
    )


@query(
    "hash_tag",
    """SELECT event_id, CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR)
            WHEN 'view' THEN CAST(user_id AS VARCHAR) WHEN 'error' THEN '{}:' || CAST(user_id AS VARCHAR)
            WHEN 'signup' THEN CAST(user_id AS VARCHAR) || ':stream'
            ELSE '{' || CAST(user_id AS VARCHAR) END AS tag
       FROM events""",
)
def hash_tag(spark, sf):
    user = F.col("user_id").cast("string")
    key = (
        F.when(F.col("kind") == "click", F.concat(F.lit("{"), user, F.lit("}:stream")))
        .when(F.col("kind") == "view", F.concat(F.lit("x{"), user, F.lit("}y{z}")))
        .when(F.col("kind") == "error", F.concat(F.lit("{}:"), user))
        .when(F.col("kind") == "signup", F.concat(user, F.lit(":stream")))
        .otherwise(F.concat(F.lit("{"), user))
    )
    return inputs.entries(spark, sf).select("event_id", ids.hash_tag(key).alias("tag"))


@query(
    "dedup_key",
    f"""SELECT event_id, '{{blocks}}:block:' || hash AS dedup_key,
            '{{blocks}}:published:' || hash AS marker_key FROM ({_ENTRIES})""",
)
def dedup_key(spark, sf):
    key = F.lit(STREAM_KEY)
    return inputs.entries(spark, sf).select(
        "event_id",
        ids.scoped_key(key, "block", F.col("hash")).alias("dedup_key"),
        ids.scoped_key(key, "published", F.col("hash")).alias("marker_key"),
    )
