"""Velocity in arrival order, replayed in batch.

A consumer that remembers event times and, at each event, forgets those older than
the window sees late events differently from a time-ordered count: what a newer
event made it forget stays forgotten, and a late event still counts the newer times
it remembers.  So an event leaves the memory at the first later arrival that is more
than one window ahead of it.

Arrival numbers are cut into chunks, which bounds what one task has to replay even
for a customer that owns most events.  A fold over one chunk counts its own events and
ends with those it still remembers.  Each of these looks for the first later chunk whose
latest time is beyond its reach, in one pass over survivors beside chunk maxima, and then
for the arrival in that chunk.  The count at an arrival is

    what its chunk remembers + what the chunk took over - what of that has left since.

No row carries a list: a survivor is one row in each step, however many chunks it outlives.
"""

from bisect import bisect_left
from functools import partial
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.config import Settings
from riskloom.session import stored

KEYS = ["customer_id", "chunk"]
SURVIVOR, PEAK = 0, 1
CARRIED, LEFT, ARRIVED = 0, 1, 2


def _replayed(batches, window_us: int):
    """Rows come sorted by customer, chunk, seq; one row per arrival with its count `n`, and at the end of a
    chunk one per event that it still remembers, without a count.

    Holds only the times that are still remembered, not the group.
    """
    columns = [*KEYS, "seq", "at", "n"]
    group, remembered = None, []

    def survivors():
        return [(*group, seq, at, None) for at, seq in remembered]

    for batch in batches:
        done = []
        rows = zip(batch.customer_id, batch.chunk, batch.seq, batch["at"], strict=True)
        for customer, chunk, seq, at in rows:
            if (customer, chunk) != group:
                done += survivors()
                group, remembered = (customer, chunk), []
            while remembered and remembered[0][0] < at - window_us:
                heappop(remembered)
            heappush(remembered, (at, seq))
            done.append((customer, chunk, seq, at, len(remembered)))
        yield pd.DataFrame(done, columns=columns).astype({"n": "Int64"})
    yield pd.DataFrame(survivors(), columns=columns).astype({"n": "Int64"})


def _first_beyond(batches):
    """Rows come sorted by customer and share, latest chunk first, survivors of a chunk before its peak.

    Per survivor the first later chunk whose peak is above its limit, if there is one.  Peaks are kept while no
    earlier chunk has a greater one, so they rise with distance and the one looked for is found by bisection.
    """
    columns = ["customer_id", "chunk", "limit"]
    group, chunks, falling = None, [], []
    for batch in batches:
        found = []
        rows = zip(batch.customer_id, batch.share, batch.chunk, batch.kind, batch.value, strict=True)
        for customer, share, chunk, kind, value in rows:
            if (customer, share) != group:
                group, chunks, falling = (customer, share), [], []
            if kind == PEAK:
                while falling and -falling[-1] <= value:
                    falling.pop()
                    chunks.pop()
                falling.append(-value)
                chunks.append(chunk)
                continue
            above = bisect_left(falling, -value)
            if above:
                found.append((customer, chunks[above - 1], value))
        yield pd.DataFrame(found, columns=columns).astype({"chunk": "int64", "limit": "int64"})


def _chunks(events: DataFrame, rows_per_share: int) -> DataFrame:
    """Per customer and chunk: its latest time, whether others follow, and the shares its survivors are dealt to.

    A customer gets a share for every `rows_per_share` events, so the work on its survivors spreads with its size;
    its chunk maxima, few beside the events, are repeated in each.
    """
    own = Window.partitionBy("customer_id")
    summary = events.groupBy(*KEYS).agg(F.max("at").alias("latest"), F.count("*").alias("size"))
    return stored(
        summary.select(
            *KEYS,
            "latest",
            (F.col("chunk") < F.max("chunk").over(own)).alias("is_followed"),
            (F.col("chunk") > F.min("chunk").over(own)).alias("follows"),
            (F.expr(f"sum(size) OVER (PARTITION BY customer_id) div {rows_per_share}") + 1).alias("shares"),
        )
    )


def _ends(survivors: DataFrame, chunks: DataFrame, window_us: int) -> DataFrame:
    """(customer, chunk in which a survivor is forgotten, limit): the chunk's first arrival above the limit does it."""
    several = chunks.where("is_followed OR follows")
    asked = survivors.select(
        "customer_id",
        F.pmod(F.xxhash64("seq"), F.col("shares")).alias("share"),
        "chunk",
        F.lit(SURVIVOR).alias("kind"),
        (F.col("at") + window_us).alias("value"),
    )
    peaks = several.select(
        "customer_id",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)),
        "chunk",
        F.lit(PEAK),
        "latest",
    )
    return (
        asked.unionAll(peaks)
        .repartition("customer_id", "share")
        .sortWithinPartitions("customer_id", "share", F.desc("chunk"), "kind")
        .mapInPandas(_first_beyond, "customer_id string, chunk long, limit long")
    )


def _departures(events: DataFrame, ends: DataFrame) -> DataFrame:
    """Per arrival that ends the stay of events of earlier chunks: how many."""
    # Latest first, and at equal times the question before the arrivals: the smallest
    # arrival number so far is then the first arrival strictly beyond the limit.
    beyond = (
        Window.partitionBy(*KEYS)
        .orderBy(F.desc("at"), "is_arrival")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    asked = ends.select(*KEYS, F.col("limit").alias("at"), F.lit(None).cast("long").alias("seq"), F.lit(0))
    # Nothing is sorted where nothing ends.
    touched = events.join(ends.select(*KEYS).distinct(), KEYS, "left_semi")
    return (
        touched.select(*KEYS, "at", "seq", F.lit(1).alias("is_arrival"))
        .unionAll(asked)
        .withColumn("seq", F.min("seq").over(beyond))
        .where(F.col("is_arrival") == 0)
        .groupBy(*KEYS, "seq")
        .agg(F.count("*").alias("gone"))
    )


def _taken_over(chunks: DataFrame, survivors: DataFrame, ends: DataFrame) -> DataFrame:
    """Per chunk the number of earlier events that are remembered when it begins; chunks without any are left out."""
    change = (
        survivors.groupBy(*KEYS).agg(F.count("*").alias("step"))
        .unionAll(ends.groupBy(*KEYS).agg(-F.count("*")))
        .unionAll(chunks.where("follows").select(*KEYS, F.lit(0).cast("long")))
        .groupBy(*KEYS)
        .agg(F.sum("step").alias("step"))
    )
    before = Window.partitionBy("customer_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return change.withColumn("n", F.sum("step").over(before)).where("n > 0").select(*KEYS, "n")


def arrival_counts(events: DataFrame, settings: Settings) -> DataFrame:
    """customer_id, seq and `n`, the remembered times including the event's own.

    `events` are read several times: pass a stored table.
    """
    window_us = settings.velocity_window_seconds * 1_000_000
    events = events.select("customer_id", F.expr(f"seq div {settings.arrival_chunk}").alias("chunk"), "seq", "at")
    chunks = _chunks(events, settings.arrival_chunk)
    replayed = stored(
        events.repartition(*KEYS)
        .sortWithinPartitions(*KEYS, "seq")
        .mapInPandas(
            partial(_replayed, window_us=window_us), "customer_id string, chunk long, seq long, at long, n long"
        )
    )
    counted = replayed.where("n IS NOT NULL").select(*KEYS, "seq", F.lit(ARRIVED).alias("kind"), "n")
    followed = chunks.where("is_followed")
    if followed.isEmpty():
        return counted.select("customer_id", "seq", "n")
    survivors = replayed.where("n IS NULL").join(followed, KEYS)
    ends = stored(_ends(survivors, chunks, window_us))
    # Negative counts take away; what was taken over comes before the first arrival.
    left = _departures(events, ends).select(*KEYS, "seq", F.lit(LEFT), -F.col("gone"))
    carried = _taken_over(chunks, survivors, ends).select(*KEYS, F.lit(-1).cast("long"), F.lit(CARRIED), "n")
    upto = Window.partitionBy(*KEYS).orderBy("seq", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outside = F.sum(F.when(F.col("kind") != ARRIVED, F.col("n")).otherwise(0)).over(upto)
    return (
        counted.unionAll(left)
        .unionAll(carried)
        .withColumn("n", F.col("n") + outside)
        .where(F.col("kind") == ARRIVED)
        .select("customer_id", "seq", "n")
    )
