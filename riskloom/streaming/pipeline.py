"""One streaming job for all sinks: every message is read and parsed once.

Accepted and rejected messages pass the stateful operator together, so the source has one reader.  What comes out,
typed decisions and rejects, is kept for the time of a micro-batch, and the branches are written from it: scored topic,
alert topic, dead letters, decision table.  Nothing that this job wrote has to be decoded again for the next sink.

Delivery is at least once: a batch that is tried again may repeat messages in the topics; the table finishes what the
first try staged.  The separate jobs of `streaming.jobs` remain for sinks that follow topics on their own.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.config import DEFAULTS, TOPIC_ALERTS, TOPIC_DEAD_LETTER, TOPIC_RAW, TOPIC_SCORED, Artifact, Settings
from riskloom.functions.contract import decode_transactions, rejected, to_message
from riskloom.functions.scoring import DECISION_COLUMNS, decision_records, risky_merchant, with_scores
from riskloom.operators.dead_letter import dead_letters
from riskloom.operators.ops import alerts
from riskloom.operators.store import store_rows, upsert
from riskloom.session import prepare
from riskloom.sources.topics import POSITION, Topics
from riskloom.streaming.state import CARRIED, CARRIED_NAMES, DERIVED, ROCKSDB, CustomerHistory

# Rejects have no customer to be grouped by; they are dealt to so many groups without state.
REJECT_GROUPS = 64
CUSTOMER, REJECT = "c:", "r:"
# What a dead letter needs; accepted messages leave their body behind.
ORIGINAL = "key binary, value binary, errors array<string>"
NAMES = [*CARRIED_NAMES, *(part.strip().split(" ")[0] for part in f"{ORIGINAL}, {DERIVED}".split(", "))]


class Outcomes(CustomerHistory):
    """Features for the accepted messages of a customer; rejected ones pass unchanged and touch no state."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0].startswith(REJECT):
            for batch in rows:
                nothing = pd.Series([None] * len(batch), index=batch.index)
                yield batch.assign(
                    transaction_count_5m=nothing.astype("Int32"),
                    is_new_device=nothing.astype("boolean"),
                    is_new_country=nothing.astype("boolean"),
                )[NAMES]
            return
        for batch in super().handleInputRows(key, rows, timerValues):
            yield batch[NAMES]


def outcomes(
    messages: DataFrame,
    settings: Settings = DEFAULTS,
    artifact: Artifact | None = None,
    ttl_ms: int | None = None,
) -> DataFrame:
    """One row per message of a stream: its decision, or `errors` with the original key and body."""
    messages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    refused = F.size("errors") > 0
    group = F.when(refused, F.concat(F.lit(REJECT), F.pmod("offset", F.lit(REJECT_GROUPS)).cast("string"))).otherwise(
        F.concat(F.lit(CUSTOMER), "customer_id")
    )
    thin = decode_transactions(messages).select(
        *CARRIED_NAMES,
        F.when(refused, F.col("key")).alias("key"),
        F.when(refused, F.col("value")).alias("value"),
        "errors",
        group.alias("state_key"),
    )
    featured = (
        thin.groupBy("state_key")
        .transformWithStateInPandas(
            statefulProcessor=Outcomes(settings.velocity_window_seconds, ttl_ms),
            outputStructType=f"{CARRIED}, {ORIGINAL}, {DERIVED}",
            outputMode="Append",
            timeMode="None" if ttl_ms is None else "ProcessingTime",
        )
        .withColumn("is_risky_merchant", risky_merchant(F.col("merchant_category")))
    )
    scored = with_scores(featured, settings, artifact)
    return decision_records(scored, artifact, keep=(*POSITION, "key", "value", "errors"))


def start_pipeline(
    spark: SparkSession,
    topics: Topics,
    table: str,
    checkpoints: str,
    settings: Settings = DEFAULTS,
    artifact: Artifact | None = None,
    ttl_ms: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Raw topic -> scored topic, alert topic, dead letters and decision table.

    Drains what is there and stops; with `every`, keeps running at that interval.
    """
    if ttl_ms is not None and every is None:
        # Expiring state keeps asking for batches, so a draining query would never end.
        raise ValueError("ttl_ms needs a query that keeps running: set every")
    prepare(spark)

    def publish(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            decided = kept.where(F.size("errors") == 0)
            for records, topic in ((decided, TOPIC_SCORED), (alerts(decided), TOPIC_ALERTS)):
                topics.append(to_message(records, "customer_id", DECISION_COLUMNS, keep=POSITION), topic)
            topics.append(dead_letters(rejected(kept), keep=POSITION), TOPIC_DEAD_LETTER)
            rows = store_rows(decided.select(*DECISION_COLUMNS, F.col("offset").alias("arrival")))
            upsert(rows, table, f"{checkpoints}/pipeline-staged/{number:010d}")
        finally:
            kept.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    records = outcomes(topics.stream(spark, TOPIC_RAW), settings, artifact, ttl_ms)
    writer = records.writeStream.foreachBatch(publish).option("checkpointLocation", f"{checkpoints}/pipeline")
    return writer.trigger(**trigger).start()
