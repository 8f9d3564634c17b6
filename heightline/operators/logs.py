"""Log lines as tables: labels, rules, extraction and selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import matches

# Log rules.
CONTAINER_PATTERN = "/(.*)"
DROPPED_CONTAINER = "promtail"
LOG_PATH_PATTERN = "(.+)"
LOGFMT_FIELDS = ("service", "instance", "level")


def relabel(df: DataFrame, source: str, pattern: str, target: str, template: str = "$1") -> DataFrame:
    """Set ``target`` from the groups of ``pattern`` where it matches ``source`` in full.

    Where it does not match, ``target`` keeps its value (NULL if it had none).
    """
    old = F.col(target) if target in df.columns else F.lit(None).cast("string")
    text = F.coalesce(F.col(source), F.lit(""))
    made = F.regexp_replace(text, f"^(?:{pattern})$", template)
    return df.withColumn(target, F.when(matches(F.col(source), pattern), made).otherwise(old))


def copy_label(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, F.col(source))


def drop_matching(df: DataFrame, label: str, pattern: str) -> DataFrame:
    """Leave out rows whose label matches in full."""
    return df.filter(~matches(F.col(label), pattern))


# What a container runtime wraps each line in.
DOCKER_DDL = "log STRING, stream STRING, time STRING, _corrupt_record STRING"


def unwrap_docker(df: DataFrame, line: str = "line") -> DataFrame:
    """Take lines out of the JSON objects of a container log: ``line``, ``stream`` and ``ts``.

    The line loses the line end it carries. ``broken`` marks rows whose text is
    no such object, or has no line or no time that can be read; they keep their
    text as it stands, and have no stream and no time. NULL is broken too.
    """
    read = df.withColumn("_read", F.from_json(F.col(line), DOCKER_DDL, {"columnNameOfCorruptRecord": "_corrupt_record"}))
    read = read.withColumn("_ts", F.col("_read.time").try_cast("timestamp"))
    sound = F.col("_read._corrupt_record").isNull() & F.col("_read.log").isNotNull() & F.col("_ts").isNotNull()
    read = read.withColumn("broken", ~F.coalesce(sound, F.lit(False)))
    whole = ~F.col("broken")
    others = [c for c in df.columns if c not in (line, "stream", "ts", "broken")]
    return read.select(
        *others,
        F.when(whole, F.regexp_replace("_read.log", r"\r?\n\z", "")).otherwise(F.col(line)).alias(line),
        F.when(whole, F.col("_read.stream")).alias("stream"),
        F.when(whole, F.col("_ts")).alias("ts"),
        "broken",
    )


# A token takes a quoted value whole, so that text inside it is never read as a
# field. Possessive repeats keep matching flat on long lines.
_TOKEN = r'[^\s=]++(?:=(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|\S*+))?'


def logfmt_tokens(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(_TOKEN), F.lit(0))


def logfmt_field(tokens: Column, name: str) -> Column:
    """The last value of a field, without its quotes; NULL if absent."""
    start = F.lit(f"{name}=")
    mine = F.filter(tokens, lambda t: F.startswith(t, start))
    raw = F.substr(F.try_element_at(mine, F.lit(-1)), F.lit(len(name) + 2))
    bare = F.regexp_replace(F.regexp_replace(raw, '^"|"$', ""), r'\\(["\\])', "$1")
    return F.when(F.startswith(raw, F.lit('"')), bare).otherwise(raw)


def extract_logfmt(
    df: DataFrame, line: str, service: str, pattern: str,
    fields: Sequence[str] = LOGFMT_FIELDS,
) -> DataFrame:
    """Add ``log_<field>`` for lines of matching services; other lines get NULL."""
    mine = matches(F.col(service), pattern)
    split = df.withColumn("_tokens", F.when(mine, logfmt_tokens(F.col(line))))
    return split.select(
        *df.columns, *[logfmt_field(F.col("_tokens"), f).alias(f"log_{f}") for f in fields]
    )


def promote_labels(df: DataFrame, fields: Sequence[str] = ("service", "instance")) -> DataFrame:
    """Extracted fields override the labels of the same name."""
    for field in fields:
        old = F.col(field) if field in df.columns else F.lit(None).cast("string")
        df = df.withColumn(field, F.coalesce(F.col(f"log_{field}"), old))
    return df


def select_logs(
    df: DataFrame, ts: str, start: Column, end: Column, service: str, instance_pattern: str
) -> DataFrame:
    """Lines of one service and matching instances in [start, end)."""
    return df.filter(
        (F.col(ts) >= start)
        & (F.col(ts) < end)
        & (F.col("service") == service)
        & matches(F.col("instance"), instance_pattern)
    )
