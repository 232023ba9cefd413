"""Counters, histograms, lag and alert conditions over metric and offset tables.

A series is a long run of samples, so running values per series are computed per
series and hour with `chunked_running`, not in one window per series.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.config import PROBABILITY_BUCKETS
from riskloom.functions.shape import inline_rows
from riskloom.operators.ordering import chunked_running
from riskloom.operators.selection import values_at
from riskloom.session import stored

# Default bucket bounds of a duration histogram, in seconds.
DURATION_BUCKETS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0
)
INFINITE = float("inf")
LAG_LIMIT = 1_000
PERCENTILES = (0.5, 0.95, 0.99)
HOUR_US = 3_600_000_000


def outcome_counters(
    checked: DataFrame, scored: DataFrame, kept: DataFrame, alerted: DataFrame, lines: DataFrame
) -> DataFrame:
    """Counter values after a batch, each counted from what its own step left behind.

    `checked` has the `errors` of every message; `scored`, `kept` and `alerted` are the decisions that were made,
    stored and routed; `lines` has one `line` per alert that was logged.
    """

    def by(rows: DataFrame, counter: str, label: Column) -> DataFrame:
        named = rows.groupBy(label.alias("label")).agg(F.count("*").alias("value"))
        return named.where("label IS NOT NULL").select(F.lit(counter).alias("counter"), "label", "value")

    refused, decision = F.size("errors") > 0, F.col("decision")
    return (
        by(checked, "api_transactions", F.when(refused, "rejected").otherwise("accepted"))
        .unionAll(by(checked, "detector_failures", F.when(refused, "validation")))
        .unionAll(by(scored, "detector_transactions", decision))
        .unionAll(by(kept, "store_decisions", decision))
        .unionAll(by(alerted, "alerts_received", decision))
        .unionAll(by(lines, "alerts_dispatched", F.when(F.col("line").isNotNull(), "log")))
    )


def sink_counters(stored_from: DataFrame, alerted: DataFrame, outcomes: DataFrame) -> DataFrame:
    """What the sinks did: decisions stored or unreadable, alerts received, dispatched or failed.

    `stored_from` and `alerted` are decoded messages with `errors`; `outcomes` has a `delivered` flag per
    alert that was sent out.
    """

    def named(rows: DataFrame, *pairs: tuple[str, Column]) -> DataFrame:
        entries = [F.struct(F.lit(name).alias("counter"), label.alias("label")) for name, label in pairs]
        return rows.select("value", F.inline(F.array(*entries))).where("label IS NOT NULL")

    def by_decision(checked: DataFrame) -> DataFrame:
        unread = F.size("errors") > 0
        return checked.groupBy(
            F.when(~unread, F.col("decision")).alias("decision"), unread.alias("unread")
        ).agg(F.count("*").alias("value"))

    failed = F.when(F.col("unread"), "validation")
    kept = named(by_decision(stored_from), ("store_decisions", F.col("decision")), ("store_failures", failed))
    logged = F.when(~F.col("unread"), "log")
    received = named(
        by_decision(alerted),
        ("alerts_received", F.col("decision")), ("alerts_dispatched", logged), ("alert_failures", failed),
    )
    sent = outcomes.groupBy("delivered").agg(F.count("*").alias("value"))
    reached = F.when(F.col("delivered"), "webhook")
    delivered = named(
        sent,
        ("alerts_dispatched", F.coalesce(reached, F.lit("dead_letter"))),
        ("alert_failures", F.when(~F.col("delivered"), "webhook")),
    )
    every = kept.unionByName(received).unionByName(delivered)
    return every.groupBy("counter", "label").agg(F.sum("value").alias("value"))


def histogram(
    rows: DataFrame, value: str, bounds: tuple[float, ...], keys: tuple[str, ...] = ()
) -> DataFrame:
    """Cumulative buckets (`le`, `bucket_count`), the last one unbounded; one pass."""
    counted = [F.count_if(F.col(value) <= bound).alias(f"b{i}") for i, bound in enumerate(bounds)]
    counted.append(F.count(value).alias(f"b{len(bounds)}"))
    pairs = [
        F.struct(F.lit(float(bound)).alias("le"), F.col(f"b{i}").alias("bucket_count"))
        for i, bound in enumerate((*bounds, INFINITE))
    ]
    return (
        rows.groupBy(*keys)
        .agg(*counted)
        .select(*keys, F.inline(F.array(*pairs)).alias("le", "bucket_count"))
    )


def probability_histogram(decisions: DataFrame) -> DataFrame:
    return histogram(decisions, "fraud_probability", PROBABILITY_BUCKETS)


def duration_summary(requests: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return requests.groupBy(*keys).agg(
        F.count("seconds").alias("events"),
        F.sum("seconds").alias("total_seconds"),
        F.avg("seconds").alias("mean_seconds"),
    )


def lag(high: Column, committed: Column) -> Column:
    """Messages not yet consumed; 0 while a group has not committed anything."""
    return F.when(committed < 0, 0).otherwise(F.greatest(high - committed, F.lit(0)))


def consumer_lag(
    ends: DataFrame, commits: DataFrame, on: tuple[str, ...] = ("topic", "partition")
) -> DataFrame:
    """Lag per group, topic and partition from end offsets and committed offsets.

    For a history of samples, `on` also names the sample, which keeps the keys distinct.
    """
    return ends.join(commits, list(on)).withColumn(
        "lag", lag(F.col("high"), F.col("committed"))
    )


def running_by_hour(
    samples: DataFrame, keys: list[str], running: dict[str, tuple[str, Column]], order: list[str]
) -> DataFrame:
    """chunked_running with hours of `at` (microseconds) as chunks."""
    hourly = samples.withColumn("hour", F.expr(f"at div {HOUR_US}"))
    return chunked_running(hourly, keys, "hour", order, running).drop("hour")


def _previous(samples: DataFrame, keys: list[str], hourly: str = "hour") -> DataFrame:
    """Adds `previous`, the time of the sample before this one in the series."""
    inside = Window.partitionBy(*keys, hourly).orderBy("at")
    earlier = Window.partitionBy(*keys).orderBy(hourly).rowsBetween(Window.unboundedPreceding, -1)
    last = (
        samples.groupBy(*keys, hourly)
        .agg(F.max_by(F.struct("at", "value"), "at").alias("last"))
        .select(*keys, hourly, F.last("last").over(earlier).alias("carried"))
    )
    return (
        samples.withColumn("before", F.lag(F.struct("at", "value")).over(inside))
        .join(last, [*keys, hourly])
        .withColumn("before", F.coalesce("before", "carried"))
        .drop("carried")
    )


def increase(samples: DataFrame, keys: list[str], window_seconds: int) -> DataFrame:
    """Counter growth between the samples of the last `window_seconds`, per sample.

    A value below its predecessor is a restart from zero.  Growth between two samples
    counts while both lie in (t - window, t]; it is added at the later one and taken
    away when the earlier one leaves the window, so one running sum gives the answer.
    Null where the window holds a single sample.
    """
    window_us = window_seconds * 1_000_000
    timed = samples.select(
        *keys, F.unix_micros("sampled_at").alias("at"), F.col("value").cast("double").alias("value")
    ).withColumn("hour", F.expr(f"at div {HOUR_US}"))
    value, before = F.col("value"), F.col("before.value")
    grown = F.when(value >= before, value - before).otherwise(value)
    linked = _previous(timed, keys).select(
        *keys,
        "at",
        F.when(F.col("at") - F.col("before.at") < window_us, grown).alias("grown"),
        F.col("before.at").alias("since"),
    )
    both = inline_rows(
        ("at", "step", "kind"),
        (F.col("at"), F.col("grown"), F.lit(1)),
        (F.col("since") + window_us, -F.col("grown"), F.lit(0)),
    )
    steps = linked.select(*keys, both).where((F.col("kind") == 1) | (F.col("step") < 0))
    total = F.coalesce("step", F.lit(0.0))
    return (
        running_by_hour(steps, keys, {"total": ("sum", total)}, ["at", "kind"])
        .where(F.col("kind") == 1)
        .select(
            *keys,
            F.timestamp_micros("at").alias("sampled_at"),
            F.when(F.col("step").isNotNull(), F.col("total")).alias("increase"),
        )
    )


def sustained(
    conditions: DataFrame, keys: list[str], hold_seconds: int, step_seconds: int
) -> DataFrame:
    """Times at which `active` has held without a gap for `hold_seconds`, with its start.

    Input: one row per evaluation with `sampled_at` and a boolean `active`; evaluations
    more than `step_seconds` apart do not belong together.
    """
    # Evaluations are few against what they were derived from, and read four times.
    true = stored(
        conditions.where("active")
        .select(*keys, F.unix_micros("sampled_at").alias("at"), F.lit(0.0).alias("value"))
        .withColumn("hour", F.expr(f"at div {HOUR_US}"))
    )
    gap = F.col("at") - F.col("before.at") > step_seconds * 1_000_000
    marked = _previous(true, keys).withColumn(
        "opens", F.when(F.col("before").isNull() | gap, F.col("at"))
    )
    return (
        running_by_hour(
            marked.select(*keys, "at", "opens"), keys, {"since": ("max", F.col("opens"))}, ["at"]
        )
        .where(F.col("at") - F.col("since") >= hold_seconds * 1_000_000)
        .select(
            *keys,
            F.timestamp_micros("at").alias("sampled_at"),
            F.timestamp_micros("since").alias("active_since"),
        )
    )


def lag_by_tick(lags: DataFrame, step_seconds: int = 60, lookback_seconds: int = 300) -> DataFrame:
    """Total lag per group at each tick, from the newest sample of every partition.

    A sample stays visible for `lookback_seconds`.  Samples are first reduced to the
    newest per partition and tick, so the copies made for later ticks are few.
    """
    step_us = step_seconds * 1_000_000
    micros = F.unix_micros("sampled_at")
    tick = F.expr(f"(unix_micros(sampled_at) + {step_us - 1}) div {step_us}")
    newest = (
        lags.withColumn("tick", tick)
        .groupBy("group", "topic", "partition", "tick")
        .agg(F.max_by("lag", micros).alias("lag"))
    )
    ticks = lookback_seconds // step_seconds
    seen = newest.select(
        "group",
        "topic",
        "partition",
        F.explode(F.sequence("tick", F.col("tick") + ticks - 1)).alias("visible"),
        "tick",
        "lag",
    )
    return (
        seen.groupBy("group", "topic", "partition", "visible")
        .agg(F.max_by("lag", "tick").alias("lag"))
        .groupBy("group", "visible")
        .agg(F.sum("lag").alias("lag"))
        .select("group", F.timestamp_micros(F.col("visible") * step_us).alias("sampled_at"), "lag")
    )


def lag_alerts(lags: DataFrame, limit: int = LAG_LIMIT, hold_seconds: int = 300) -> DataFrame:
    ticks = lag_by_tick(lags).withColumn("active", F.col("lag") > limit)
    return sustained(ticks, ["group"], hold_seconds, 60)


def failure_alerts(failures: DataFrame, keys: list[str], window_seconds: int = 300) -> DataFrame:
    """Samples at which a failure counter has grown within the window."""
    return increase(failures, keys, window_seconds).where(F.col("increase") > 0)


def stall_alerts(
    scored: DataFrame,
    accepted: DataFrame,
    keys: list[str],
    window_seconds: int = 600,
    hold_seconds: int = 300,
    step_seconds: int = 60,
) -> DataFrame:
    """Nothing scored while transactions kept coming in, for long enough."""

    def total(samples: DataFrame, name: str) -> DataFrame:
        grown = increase(samples, keys, window_seconds)
        return grown.groupBy("sampled_at").agg(F.sum("increase").alias(name))

    both = total(scored, "scored").join(total(accepted, "accepted"), "sampled_at")
    active = (F.col("scored") == 0) & (F.col("accepted") > 0)
    ticks = both.select(F.lit("pipeline").alias("scope"), "sampled_at", active.alias("active"))
    return sustained(ticks, ["scope"], hold_seconds, step_seconds).drop("scope")


def down_alerts(
    up: DataFrame, keys: list[str], hold_seconds: int = 60, step_seconds: int = 60
) -> DataFrame:
    """Targets whose `up` sample has been 0 for long enough."""
    return sustained(up.withColumn("active", F.col("value") == 0), keys, hold_seconds, step_seconds)


def bucket_quantile(buckets: DataFrame, quantile: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """Quantile from cumulative buckets, linear inside a bucket; NaN without any value.

    A window holds the buckets of one histogram, whose number is fixed by its bounds.
    """
    order = Window.partitionBy(*keys).orderBy("le")
    whole = Window.partitionBy(*keys)
    ranked = (
        buckets.withColumn("lower", F.coalesce(F.lag("le").over(order), F.lit(0.0)))
        .withColumn("below", F.coalesce(F.lag("bucket_count").over(order), F.lit(0)))
        .withColumn("total", F.max("bucket_count").over(whole))
    )
    rank = F.col("total") * quantile
    share = (rank - F.col("below")) / F.nullif(F.col("bucket_count") - F.col("below"), F.lit(0))
    inside = F.col("lower") + (F.col("le") - F.col("lower")) * F.coalesce(share, F.lit(0.0))
    # In the unbounded bucket only its lower bound is known.
    value = F.when(F.col("le") == INFINITE, F.col("lower")).otherwise(inside)
    reached = F.col("bucket_count") >= rank
    return ranked.groupBy(*keys).agg(
        F.when(F.max("total") > 0, F.min_by(F.when(reached, value), F.when(reached, F.col("le"))))
        .otherwise(float("nan"))
        .alias("quantile_value")
    )


def bucket_rate_quantile(
    samples: DataFrame, quantile: float, keys: list[str], window_seconds: int = 300
) -> DataFrame:
    """Quantile from the growth of cumulative bucket counters (`le`, `value`) within the window, per sample.

    The rate is the growth over a constant, which the quantile does not depend on.
    """
    grown = increase(samples, [*keys, "le"], window_seconds).where("increase IS NOT NULL")
    buckets = grown.withColumnRenamed("increase", "bucket_count")
    return bucket_quantile(buckets, quantile, (*keys, "sampled_at"))


def latency_percentiles(
    requests: DataFrame, keys: list[str], fractions: tuple[float, ...] = PERCENTILES
) -> DataFrame:
    """The element at position min(n - 1, floor(n * f)) of each group's sorted seconds."""
    places = {
        f"p{round(fraction * 100)}": lambda size, fraction=fraction: F.least(size - 1, F.floor(size * fraction))
        for fraction in fractions
    }
    return values_at(requests, keys, F.col("seconds"), places)


def throughput(requests: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Requests per second between the first start and the last finish."""
    elapsed = (
        F.unix_micros(F.max("finished_at")) - F.unix_micros(F.min("started_at"))
    ) / 1_000_000
    return requests.groupBy(*keys).agg(
        F.count("*").alias("requests"),
        elapsed.alias("elapsed_seconds"),
        F.when(elapsed > 0, F.count("*") / elapsed).alias("per_second"),
    )


def pipeline_throughput(accepted: DataFrame, kept: DataFrame) -> DataFrame:
    """Rates of what came in (`accepted_at`) and of what reached the store (`processed_at`).

    Both count from the first acceptance; without any elapsed time a rate is null.
    """
    start, end = F.unix_micros(F.min("accepted_at")), F.unix_micros(F.max("accepted_at"))
    came = accepted.agg(F.count("*").alias("accepted"), start.alias("start"), end.alias("end"))
    stays = kept.agg(F.count("*").alias("stored"), F.unix_micros(F.max("processed_at")).alias("done"))
    both = came.withColumn("one", F.lit(1)).join(stays.withColumn("one", F.lit(1)), "one")

    def rate(count: str, until: str) -> Column:
        seconds = (F.col(until) - F.col("start")) / 1_000_000
        return F.when(seconds > 0, F.col(count) / seconds)

    return both.select(
        "accepted", "stored",
        rate("accepted", "end").alias("ingest_per_second"), rate("stored", "done").alias("end_to_end_per_second"),
    )
