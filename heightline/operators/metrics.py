"""Counters, gauges, histograms and rates over tables of samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import CHUNK, SMALL_KEY_ROWS, has_large_key, ordered_chunks

# Bucket bounds in milliseconds.
LATENCY_BOUNDS = (5, 10, 20, 50, 100, 200, 500, 1000, 2000)
END_TO_END_BOUNDS = (30, 35, 40, 45, 50, 60)


def count_by(df: DataFrame, labels: Sequence[str], out: str = "total") -> DataFrame:
    """A counter per label set."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias(out))


def count_many(df: DataFrame, counters: dict[str, tuple[Column, Sequence[str]]]) -> DataFrame:
    """Several labelled counters in one pass over the samples.

    ``counters`` maps a name to its condition and its label columns. Result:
    counter, every label used (NULL where a counter lacks it), total.
    """
    labels = sorted({label for _, used in counters.values() for label in used})
    entries = []
    for name, (condition, used) in counters.items():
        values = [
            (F.col(label) if label in used else F.lit(None)).cast("string").alias(label)
            for label in labels
        ]
        entries.append(F.when(condition, F.struct(F.lit(name).alias("counter"), *values)))
    hits = df.select(F.inline(F.array_compact(F.array(*entries))))
    return count_by(hits, ["counter", *labels])


def publish_rate(df: DataFrame, ok: Column, labels: Sequence[str]) -> DataFrame:
    """Attempts, successes, errors and the share of successes in percent."""
    return (
        df.groupBy(*labels)
        .agg(
            F.count(F.lit(1)).alias("attempts"),
            F.count_if(ok).alias("success"),
            F.count_if(~ok).alias("errors"),
        )
        .withColumn("success_rate", percent(F.col("success"), F.col("attempts")))
    )


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole with the divisor held at 1 or above."""
    return F.lit(100.0) * part / F.greatest(whole, F.lit(1))


def histogram(
    df: DataFrame, value: Column, bounds: Sequence[int], labels: Sequence[str]
) -> DataFrame:
    """Cumulative buckets per label set, with the count and sum of values.

    One conditional count per bound in a single aggregation, turned into rows
    afterwards. Result: labels, le, bucket_count, total_count, total_sum.
    """
    counted = df.withColumn("_v", value).groupBy(*labels).agg(
        *[F.count_if(F.col("_v") <= F.lit(b)).alias(f"_le{i}") for i, b in enumerate(bounds)],
        F.count("_v").alias("total_count"),
        F.sum("_v").alias("total_sum"),
    )
    buckets = F.array(
        *[
            F.struct(F.lit(str(b)).alias("le"), F.col(f"_le{i}").alias("n"))
            for i, b in enumerate(bounds)
        ],
        F.struct(F.lit("+Inf").alias("le"), F.col("total_count").alias("n")),
    )
    return counted.select(
        *labels, F.explode(buckets).alias("_b"), "total_count", "total_sum"
    ).select(
        *labels,
        F.col("_b.le").alias("le"),
        F.col("_b.n").alias("bucket_count"),
        "total_count",
        "total_sum",
    )


def gauge_last(
    df: DataFrame, labels: Sequence[str], ts: str, value: str, tie: Sequence[str] = ()
) -> DataFrame:
    """The newest value of each series; of equal times the last by ``tie``, then the largest value."""
    return df.groupBy(*labels).agg(
        F.max_by(value, F.struct(ts, *tie, value)).alias(value), F.max(ts).alias(ts)
    )


def rescaled(value: Column, divisor: float) -> Column:
    """A gauge in a larger unit, such as bytes shown as megabytes."""
    return value / F.lit(float(divisor))


def average_by(df: DataFrame, labels: Sequence[str], series: Sequence[str], ts: str, value: str) -> DataFrame:
    """Average over the newest sample of every series, by label."""
    newest = gauge_last(df, [*labels, *[s for s in series if s not in labels]], ts, value)
    return newest.groupBy(*labels).agg(F.avg(value).alias("average"))


def throughput(df: DataFrame, ts: str, width: str = "1 minute", labels: Sequence[str] = ()) -> DataFrame:
    """Rows per tumbling window."""
    return (
        df.groupBy(F.window(ts, width).alias("_w"), *labels)
        .agg(F.count(F.lit(1)).alias("total"))
        .select(F.col("_w.start").alias("window_start"), *labels, "total")
    )


def sliding_count(
    df: DataFrame, ts: str, width_s: int, step_s: int, labels: Sequence[str] = ()
) -> DataFrame:
    """Rows in each window of ``width_s`` seconds, one window every ``step_s``.

    Rows are counted once per step first; only those counts are copied into the
    windows they belong to, not the rows.
    """
    if width_s % step_s:
        raise ValueError("the window width must be a multiple of the step")
    pane = F.window(ts, f"{step_s} seconds")
    panes = df.groupBy(pane.alias("_p"), *labels).agg(F.count(F.lit(1)).alias("_n"))
    first = F.unix_seconds(F.col("_p.start").cast("timestamp"))
    starts = F.sequence(first - F.lit(width_s - step_s), first, F.lit(step_s).cast("bigint"))
    return (
        panes.withColumn("_s", F.explode(starts))
        .groupBy("_s", *labels)
        .agg(F.sum("_n").alias("total"))
        .select(F.timestamp_seconds("_s").alias("window_start"), *labels, "total")
    )


def label_values(df: DataFrame, label: str) -> DataFrame:
    """The distinct values of a label."""
    return df.select(label).filter(F.col(label).isNotNull()).distinct()


def _growth(value: str, previous: str) -> Column:
    # A counter that falls was reset and has grown from zero since.
    return F.when(F.col(value) < F.col(previous), F.col(value)).otherwise(
        F.col(value) - F.col(previous)
    )


def counter_states(
    df: DataFrame, series: Sequence[str], order: Sequence[str], value: str, floor: int = SMALL_KEY_ROWS
) -> DataFrame:
    """What a counter did over its samples: first_value, last_value, increase, resets, samples.

    Two states of one series that follow each other merge: increases, resets and
    samples add up, and the step from the last value of the one to the first of
    the other counts like any step. ``series`` should include the range that is
    looked at. Series too large for one task are cut into chunks, whose states
    are merged so.
    """
    at = F.struct(*order)
    if not has_large_key(df, series, floor):
        w = Window.partitionBy(*series).orderBy(*order)
        return (
            df.withColumn("_before", F.lag(value).over(w))
            .groupBy(*series)
            .agg(
                F.min_by(value, at).alias("first_value"),
                F.max_by(value, at).alias("last_value"),
                F.coalesce(F.sum(_growth(value, "_before")), F.lit(0.0)).alias("increase"),
                F.count_if(F.col(value) < F.col("_before")).alias("resets"),
                F.count(F.lit(1)).alias("samples"),
            )
        )
    chunks = ordered_chunks(df, series, order)
    w = Window.partitionBy(*series, CHUNK).orderBy(*order)
    pieces = (
        chunks.withColumn("_before", F.lag(value).over(w))
        .groupBy(*series, CHUNK)
        .agg(
            F.sum(_growth(value, "_before")).alias("_inner"),
            F.count_if(F.col(value) < F.col("_before")).alias("_resets"),
            F.min_by(value, at).alias("_first"),
            F.max_by(value, at).alias("_last"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    # One row per series and chunk from here on.
    joined = Window.partitionBy(*series).orderBy(CHUNK)
    return (
        pieces.withColumn("_before", F.lag("_last").over(joined))
        .groupBy(*series)
        .agg(
            F.min_by("_first", CHUNK).alias("first_value"),
            F.max_by("_last", CHUNK).alias("last_value"),
            (
                F.coalesce(F.sum("_inner"), F.lit(0.0))
                + F.coalesce(F.sum(_growth("_first", "_before")), F.lit(0.0))
            ).alias("increase"),
            (F.sum("_resets") + F.count_if(F.col("_first") < F.col("_before"))).alias("resets"),
            F.sum("_n").alias("samples"),
        )
    )


def counter_increase(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "increase",
    floor: int = SMALL_KEY_ROWS,
) -> DataFrame:
    """Growth of a counter over its samples, allowing for resets; a series with one sample has grown by 0."""
    states = counter_states(df, series, order, value, floor)
    return states.select(*series, F.col("increase").alias(out), "samples")


def sliding_rate(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    tie: Sequence[str],
    value: str,
    width_s: int,
    step_s: int,
    floor: int = SMALL_KEY_ROWS,
) -> DataFrame:
    """Per-second growth of each series over the last ``width_s`` seconds, one range every ``step_s``.

    Samples shrink to one counter state per series and pane of ``step_s``, and no
    sample is copied into ranges. A pane's growth is its own increase and the
    step that leads into it from the pane before; a range is the sum over its
    panes, less the step into its first one. Each range that holds a sample has
    one row, put next to the last pane it reaches.

    Ranges start at multiples of the step. Only samples inside a range count, and
    growth is not extrapolated to its edges. NULL labels are labels like any
    other; NULL values are no samples. Result: range_start, series, samples,
    resets, increase, rate.
    """
    if width_s % step_s:
        raise ValueError("the range must be a multiple of the step")
    panes = width_s // step_s
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    paned = df.filter(F.col(value).isNotNull()).select(
        F.floor(seconds / F.lit(step_s)).alias("_pane"), *series, ts, *tie, value
    )
    states = counter_states(paned, [*series, "_pane"], [ts, *tie], value, floor)
    # One row per series and pane from here on: a year of hours is 8,760.
    w = Window.partitionBy(*series).orderBy("_pane")
    before = F.lag("last_value").over(w)
    linked = states.select(
        *series,
        "_pane",
        "samples",
        "resets",
        "increase",
        F.coalesce(
            F.when(F.col("first_value") < before, F.col("first_value")).otherwise(F.col("first_value") - before), F.lit(0.0)
        ).alias("_step"),
        F.coalesce((F.col("first_value") < before).cast("bigint"), F.lit(0)).alias("_fell"),
        # Ranges whose last pane with samples this is.
        F.least(F.coalesce(F.lead("_pane").over(w) - 1, F.col("_pane") + panes - 1), F.col("_pane") + panes - 1).alias("_until"),
    )
    ends = linked.withColumn("_end", F.explode(F.sequence("_pane", "_until")))
    real = F.col("_end") == F.col("_pane")
    ends = ends.select(
        *series,
        "_end",
        *(F.when(real, F.col(c)).alias(c) for c in ("samples", "resets", "increase", "_step", "_fell")),
    )
    reach = Window.partitionBy(*series).orderBy("_end").rangeBetween(-(panes - 1), Window.currentRow)

    def over(inner: str, step: str) -> Column:
        first = F.first(step, ignorenulls=True).over(reach)
        return F.sum(F.col(inner) + F.col(step)).over(reach) - first

    return ends.select(
        F.timestamp_seconds((F.col("_end") - (panes - 1)) * step_s).alias("range_start"),
        *series,
        F.sum("samples").over(reach).alias("samples"),
        over("resets", "_fell").alias("resets"),
        over("increase", "_step").alias("increase"),
    ).withColumn("rate", F.col("increase") / F.lit(float(width_s)))


def counter_rate(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    tie: Sequence[str],
    value: str,
    width: str,
    seconds: int,
    floor: int = SMALL_KEY_ROWS,
) -> DataFrame:
    """Per-second growth of each series in tumbling ranges.

    Only samples inside a range count towards it; growth is not extrapolated to
    the edges of the range. Result: range_start, series, samples, increase, rate.
    """
    ranged = df.withColumn("range_start", F.window(ts, width)["start"]).select(
        "range_start", *series, ts, *tie, value
    )
    grown = counter_increase(ranged, ["range_start", *series], [ts, *tie], value, floor=floor)
    return grown.withColumn("rate", F.col("increase") / F.lit(float(seconds)))


def sum_rates(rates: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rates of all series added up by label."""
    return rates.groupBy(*labels).agg(F.sum("rate").alias("rate"))


def select_labels(df: DataFrame, matchers: dict[str, str]) -> DataFrame:
    """Rows whose labels match each pattern in full."""
    for label, pattern in matchers.items():
        df = df.filter(matches(F.col(label), pattern))
    return df


def matches(label: Column, pattern: str) -> Column:
    """Whether a pattern matches the whole label, a newline at its end included."""
    return F.coalesce(label, F.lit("")).rlike(f"\\A(?:{pattern})\\z")
