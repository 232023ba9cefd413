"""Per-customer features: five-minute velocity, first-seen device and country.

Two orders are offered.  `event_time` treats the events of a customer as if they
had arrived in the order (event_time, seq).  `arrival` replays them by `seq`, as a
consumer of the topic sees them, late events included.  Both give the same result
on input that arrives in time order.

A customer may own a large share of all events, so nothing here is partitioned by
customer alone.  Velocity is counted per (customer, time slot of one window
length); a row is also needed in the slot after its own, where a thin copy of it
is sent.  First-seen flags depend only on the earliest event of each device and
country, which a map-side combined aggregate finds; those few events are sent along
as marks, so the flags cost no join and no second exchange of the payload.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.config import DEFAULTS, Settings
from riskloom.functions.scoring import feature_vector, risky_merchant
from riskloom.functions.shape import inline_rows
from riskloom.operators.arrival import arrival_counts
from riskloom.operators.ordering import running_totals
from riskloom.session import stored

PROBE, MARK, COPY, EVENT = -1, 0, 1, 2
NEW_DEVICE, NEW_COUNTRY, NEW_CUSTOMER = 1, 2, 3
# More than any arrival number, so one decimal can hold (time, seq) in sort order.
SEQ_RANGE = "10000000000000000000BD"


def seen_combinations(events: DataFrame, by_time: bool) -> DataFrame:
    """Row count and earliest event per (customer, device, country), stored.

    It is read for the marks and for finding hot customers; storing the combined rows
    saves another pass over the events.  The order key is a single number on purpose:
    unlike the minimum of a struct, the minimum of a number is aggregated by hash,
    without sorting the events.
    """
    key = F.expr(f"CAST(at AS DECIMAL(20, 0)) * {SEQ_RANGE} + seq") if by_time else F.col("seq")
    return stored(
        events.groupBy("customer_id", "device_id", "country_code").agg(
            F.min(key).alias("first"), F.count("*").alias("n")
        )
    )


def first_seen_marks(seen: DataFrame, by_time: bool) -> DataFrame:
    """One thin row per first event of a device, a country or a customer."""
    openers = inline_rows(
        ("opener", "value"),
        (F.lit(NEW_DEVICE), F.col("device_id")),
        (F.lit(NEW_COUNTRY), F.col("country_code")),
        (F.lit(NEW_CUSTOMER), F.lit("")),
    )
    firsts = (
        seen.select("customer_id", "first", openers)
        .groupBy("customer_id", "opener", "value")
        .agg(F.min("first").alias("first"))
    )
    if not by_time:
        return firsts.select("customer_id", F.col("first").alias("seq"), "opener")
    seq = f"pmod(first, {SEQ_RANGE})"
    return firsts.select(
        "customer_id",
        F.expr(f"(first - {seq}) div {SEQ_RANGE}").alias("at"),
        F.expr(f"CAST({seq} AS BIGINT)").alias("seq"),
        "opener",
    )


def _flags(over: Window | None = None) -> dict[str, Column]:
    """New means first of its device or country, but not of the customer."""

    def marked(opener: int) -> Column:
        found = F.max(F.when(F.col("opener") == opener, 1).otherwise(0))
        return (found if over is None else found.over(over)) == 1

    return {
        "is_new_device": marked(NEW_DEVICE) & ~marked(NEW_CUSTOMER),
        "is_new_country": marked(NEW_COUNTRY) & ~marked(NEW_CUSTOMER),
    }


def _slots(events: DataFrame, seen: DataFrame, window_us: int) -> DataFrame:
    """Every event in its own slot and, without payload, in the next one; and the marks."""
    slot = F.expr(f"at div {window_us}")
    no_row = F.lit(None).cast(events.schema["row"].dataType)
    twice = inline_rows(
        ("slot", "kind", "row"),
        (slot, F.lit(EVENT), F.col("row")),
        (slot + 1, F.lit(COPY), no_row),
    )
    counted = events.select(
        "customer_id", "at", "seq", F.lit(None).cast("int").alias("opener"), twice
    )
    marks = first_seen_marks(seen, by_time=True).select(
        "customer_id", "at", "seq", "opener", slot, F.lit(MARK), no_row
    )
    return counted.unionAll(marks)


def hot_slots(
    events: DataFrame, seen: DataFrame, window_us: int, limit: int
) -> DataFrame | None:
    """(customer, slot) groups above `limit` rows, copies included; None without any.

    At most rows / limit customers can have that many, and only their slots are counted.
    """
    heavy = (
        seen.groupBy("customer_id")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > limit)
        .select("customer_id")
    )
    if heavy.isEmpty():
        return None
    slot = F.expr(f"at div {window_us}")
    hot = stored(
        events.join(heavy, "customer_id", "left_semi")
        .select("customer_id", F.explode(F.array(slot, slot + 1)).alias("slot"))
        .groupBy("customer_id", "slot")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > limit)
        .select("customer_id", "slot")
    )
    return None if hot.isEmpty() else hot


def _counted_by_slot(rows: DataFrame, window_us: int) -> DataFrame:
    """Events in [t - window, t], up to and including this one, per (customer, slot).

    Written as "all so far" minus "older than the window": both frames start at the
    partition's first row, so each is one pass; a sliding frame would be re-summed
    for every row.
    """
    slot = Window.partitionBy("customer_id", "slot")
    so_far = slot.orderBy("at", "seq", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    expired = slot.orderBy("at").rangeBetween(Window.unboundedPreceding, -(window_us + 1))
    counts = F.when(F.col("kind") >= COPY, 1).otherwise(0)
    same_event = Window.partitionBy("customer_id", "slot", "at", "seq")
    return (
        rows.withColumn("seen", F.sum(counts).over(so_far))
        .withColumn("gone", F.coalesce(F.sum(counts).over(expired), F.lit(0)))
        .withColumns(_flags(same_event))
        .where(F.col("kind") == EVENT)
        .select(
            "row",
            (F.col("seen") - F.col("gone")).cast("int").alias("transaction_count_5m"),
            "is_new_device",
            "is_new_country",
        )
    )


def _counted_by_rank(rows: DataFrame, window_us: int) -> DataFrame:
    """The same result for slots too large for a task, from global running totals.

    Each event sends a probe to the start of its window.  The running number of
    events at the event minus the one at its probe is its count; what lies before the
    slot cancels out.  Everything is spread by (customer, slot, time, seq).
    """
    probe = (
        rows.where(F.col("kind") == EVENT)
        .withColumn("at", F.col("at") - window_us)
        .withColumn("kind", F.lit(PROBE))
    )
    thin = [column for column in rows.columns if column != "row"]
    ordered = running_totals(
        rows.select(*thin)
        .unionAll(probe.select(*thin))
        # A probe sorts before every event at the same instant, whatever its seq.
        .withColumn("is_event", F.col("kind") >= MARK),
        ["customer_id", "slot", "at", "is_event", "seq", "kind"],
        {"seen": F.when(F.col("kind") >= COPY, 1).otherwise(0)},
    )
    sign = F.when(F.col("kind") == EVENT, 1).when(F.col("kind") == PROBE, -1).otherwise(0)
    features = (
        ordered.where(F.col("kind") != COPY)
        .groupBy("customer_id", "seq")
        .agg(
            F.sum(sign * F.col("seen")).cast("int").alias("transaction_count_5m"),
            *[flag.alias(name) for name, flag in _flags().items()],
        )
    )
    return (
        rows.where(F.col("kind") == EVENT)
        .select("customer_id", "seq", "row")
        .join(features, ["customer_id", "seq"])
        .select("row", "transaction_count_5m", "is_new_device", "is_new_country")
    )


def _in_event_time(events: DataFrame, settings: Settings) -> DataFrame:
    window_us = settings.velocity_window_seconds * 1_000_000
    seen = seen_combinations(events, by_time=True)
    rows = _slots(events, seen, window_us)
    hot = hot_slots(events, seen, window_us, settings.hot_group_rows)
    if hot is None:
        return _counted_by_slot(rows, window_us)
    keys = ["customer_id", "slot"]
    normal = _counted_by_slot(rows.join(hot, keys, "left_anti"), window_us)
    return normal.unionAll(_counted_by_rank(rows.join(hot, keys, "left_semi"), window_us))


def _in_arrival_order(events: DataFrame, settings: Settings) -> DataFrame:
    # Stored once without payload: what follows reads it several times.
    thin = stored(events.drop("row"))
    counts = arrival_counts(thin, settings)
    marks = first_seen_marks(seen_combinations(thin, by_time=False), by_time=False)
    # Counts and marks meet the payload on the unique (customer, seq), which cannot be hot.
    features = (
        counts.select("customer_id", "seq", "n", F.lit(None).cast("int").alias("opener"))
        .unionAll(marks.select("customer_id", "seq", F.lit(None).cast("long"), "opener"))
        .groupBy("customer_id", "seq")
        .agg(
            F.max("n").cast("int").alias("transaction_count_5m"),
            *[flag.alias(name) for name, flag in _flags().items()],
        )
    )
    return events.join(features, ["customer_id", "seq"]).select(
        "row", "transaction_count_5m", "is_new_device", "is_new_country"
    )


def with_features(
    txns: DataFrame,
    settings: Settings = DEFAULTS,
    order: str = "event_time",
    distinct_by: list[str] | None = None,
) -> DataFrame:
    """Adds the four derived features to valid transactions.

    `seq` has to be unique per customer and not negative.  Repeated transactions count
    again, as they do on the topic; pass `distinct_by` to drop them first.

    The call runs one aggregate job over `txns`, the result reads them once more: pass a
    stored table when they are expensive to derive.
    """
    if order not in ("event_time", "arrival"):
        raise ValueError(f"order is {order!r}, expected 'event_time' or 'arrival'")
    if distinct_by:
        txns = txns.dropDuplicates(distinct_by)
    events = txns.select(
        "customer_id",
        "device_id",
        "country_code",
        F.unix_micros("event_time").alias("at"),
        "seq",
        F.struct(*txns.columns).alias("row"),
    )
    derived = _in_event_time if order == "event_time" else _in_arrival_order
    return derived(events, settings).select(
        "row.*",
        "transaction_count_5m",
        "is_new_device",
        "is_new_country",
        risky_merchant(F.col("row.merchant_category")).alias("is_risky_merchant"),
    )


def with_feature_vector(features: DataFrame) -> DataFrame:
    return features.withColumn("feature_vector", feature_vector())
