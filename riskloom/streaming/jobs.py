"""The streaming jobs: score, route alerts, store, notify, replay.

One stateful query turns the raw topic into the scored topic.  Everything else reads
topics, so state is computed once and each job has its own checkpoint and can fail and
restart on its own.  Delivery is at least once; the store makes repeats harmless.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from riskloom.config import (
    DEFAULTS,
    DELIVERY_EXHAUSTED,
    SOURCE_ALERTER,
    SOURCE_DELIVERY,
    SOURCE_STORE,
    TOPIC_ALERTS,
    TOPIC_DEAD_LETTER,
    TOPIC_RAW,
    TOPIC_SCORED,
    Artifact,
    Settings,
)
from riskloom.functions.contract import (
    decode_decisions,
    decode_transactions,
    rejected,
    to_message,
    valid,
)
from riskloom.functions.scoring import DECISION_COLUMNS, decision_records, with_scores
from riskloom.functions.text import alert_line
from riskloom.operators.dead_letter import dead_letters, replayable
from riskloom.operators.ops import alerts
from riskloom.operators.ordering import running_totals
from riskloom.operators.store import store_rows, upsert
from riskloom.session import prepare
from riskloom.sources.topics import POSITION, Topics
from riskloom.streaming.delivery import deliver_alerts
from riskloom.streaming.state import with_stream_features


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """Drains what is there and stops; with `every`, keeps running at that interval."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def decisions(
    messages: DataFrame,
    settings: Settings = DEFAULTS,
    artifact: Artifact | None = None,
    ttl_ms: int | None = None,
) -> DataFrame:
    """Decision records of the valid messages, with the place of the message they answer."""
    accepted = valid(decode_transactions(messages))
    scored = with_scores(with_stream_features(accepted, settings, ttl_ms), settings, artifact)
    return decision_records(scored, artifact, keep=POSITION)


def _messages(records: DataFrame) -> DataFrame:
    return to_message(records, "customer_id", DECISION_COLUMNS, keep=POSITION)


def start_scoring(
    spark: SparkSession,
    topics: Topics,
    checkpoints: str,
    settings: Settings = DEFAULTS,
    artifact: Artifact | None = None,
    ttl_ms: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Raw topic -> scored topic; decisions are counted in the query's progress."""
    if ttl_ms is not None and every is None:
        # Expiring state keeps asking for batches, so a draining query would never end.
        raise ValueError("ttl_ms needs a query that keeps running: set every")
    prepare(spark)
    records = decisions(topics.stream(spark, TOPIC_RAW), settings, artifact, ttl_ms).observe(
        "decisions",
        F.count(F.lit(1)).alias("scored"),
        F.count_if(F.col("decision") == "review").alias("review"),
        F.count_if(F.col("decision") == "decline").alias("decline"),
        F.avg("fraud_probability").alias("mean_probability"),
    )
    return _start(topics.writer(_messages(records), TOPIC_SCORED), f"{checkpoints}/scored", every)


def start_rejects(
    spark: SparkSession, topics: Topics, checkpoints: str, every: str | None = None
) -> StreamingQuery:
    """Raw topic -> dead letters of the detector."""
    prepare(spark)
    checked = decode_transactions(topics.stream(spark, TOPIC_RAW))
    letters = dead_letters(rejected(checked), keep=POSITION)
    return _to_dead_letters(topics, letters, f"{checkpoints}/rejects", every)


def _to_dead_letters(
    topics: Topics, letters: DataFrame, checkpoint: str, every: str | None
) -> StreamingQuery:
    """Several jobs share the topic, so each batch is appended, not owned by one file sink."""

    def publish(batch: DataFrame, _: int) -> None:
        topics.append(batch, TOPIC_DEAD_LETTER)

    return _start(letters.writeStream.foreachBatch(publish), checkpoint, every)


def start_alert_routing(
    spark: SparkSession, topics: Topics, checkpoints: str, every: str | None = None
) -> StreamingQuery:
    """Scored topic -> alert topic, key and body unchanged."""
    prepare(spark)
    flagged = alerts(valid(decode_decisions(topics.stream(spark, TOPIC_SCORED))))
    writer = topics.writer(flagged.select("key", "value", *POSITION), TOPIC_ALERTS)
    return _start(writer, f"{checkpoints}/alerts", every)


def start_store(
    spark: SparkSession, topics: Topics, table: str, checkpoints: str, every: str | None = None
) -> tuple[StreamingQuery]:
    """Scored topic -> decision table, and what cannot be read -> dead letters; every message is decoded once."""
    prepare(spark)
    checked = decode_decisions(topics.stream(spark, TOPIC_SCORED))
    # Readable messages leave their body behind.
    bodies = {name: F.when(F.size("errors") > 0, F.col(name)) for name in ("key", "value")}

    def merge(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            rows = store_rows(valid(kept)).withColumnRenamed("offset", "arrival")
            fresh = rows.drop("key", "value", "headers", "topic", "partition", "timestamp")
            # The same batch again finds what it staged, and finishes from there.
            upsert(fresh, table, f"{checkpoints}/store-staged/{number:010d}")
            letters = dead_letters(rejected(kept), source=SOURCE_STORE, keep=POSITION)
            topics.append(letters, TOPIC_DEAD_LETTER)
        finally:
            kept.unpersist()

    return (_start(checked.withColumns(bodies).writeStream.foreachBatch(merge), f"{checkpoints}/store", every),)


def start_alert_log(
    spark: SparkSession, topics: Topics, folder: str, checkpoints: str, every: str | None = None
) -> tuple[StreamingQuery, StreamingQuery]:
    """Alert topic -> one text line per alert, and what cannot be read -> dead letters."""
    prepare(spark)
    checked = decode_decisions(topics.stream(spark, TOPIC_ALERTS))
    lines = valid(checked).select(alert_line().alias("value"))
    writer = lines.writeStream.format("text").option("path", folder)
    letters = dead_letters(rejected(checked), source=SOURCE_ALERTER, keep=POSITION)
    return (
        _start(writer, f"{checkpoints}/alert-log", every),
        _to_dead_letters(topics, letters, f"{checkpoints}/alert-rejects", every),
    )


def start_delivery(
    spark: SparkSession,
    topics: Topics,
    deliver: Callable[[str], None],
    outcomes: str,
    checkpoints: str,
    settings: Settings = DEFAULTS,
    every: str | None = None,
) -> StreamingQuery:
    """Alert topic -> outside world; what cannot be delivered -> dead letters.

    Outcomes are written before they are split, so that an alert is not delivered a second
    time for the dead letters.
    """
    prepare(spark)
    readable = valid(decode_decisions(topics.stream(spark, TOPIC_ALERTS)))
    messages = readable.select("transaction_id", "key", "value", *POSITION)

    def send(batch: DataFrame, number: int) -> None:
        # Follows the checkpoint: a query started on a new one must not replace old outcomes.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"{outcomes}/query={query}/batch={number:010d}"
        deliver_alerts(batch, deliver, settings).write.mode("overwrite").parquet(place)
        failed = batch.sparkSession.read.parquet(place).where(~F.col("delivered"))
        letters = dead_letters(failed, SOURCE_DELIVERY, DELIVERY_EXHAUSTED, keep=POSITION)
        topics.append(letters, TOPIC_DEAD_LETTER)

    return _start(messages.writeStream.foreachBatch(send), f"{checkpoints}/delivery", every)


def processing_times(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Events and seconds per event of the batches that the query still remembers.

    Spark keeps a fixed number of progress records, so this is always a small table.
    """
    rows = [
        (p["batchId"], p["numInputRows"], p["batchDuration"] / 1000 / p["numInputRows"])
        for p in query.recentProgress
        if p["numInputRows"]
    ]
    return spark.createDataFrame(rows, "batch long, events long, seconds double")


LEDGER = ("topic", "partition", "offset", "source")


def replay(
    spark: SparkSession,
    topics: Topics,
    ledger: str,
    target: str = TOPIC_RAW,
    limit: int = 0,
    source: str | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Publishes dead letters to `target` again and returns the ones concerned.

    What was replayed is noted in `ledger`, so a later run goes on after it; a dry run
    writes nothing.  `limit` 0 takes everything that is queued.
    """
    prepare(spark)
    letters = replayable(topics.table(spark, TOPIC_DEAD_LETTER), source=source)
    done = _ledger(spark, ledger)
    if done is not None:
        letters = letters.join(done, list(LEDGER), "left_anti")
    if limit:
        letters = letters.orderBy("timestamp", *LEDGER).limit(limit)
    if dry_run:
        return letters
    # Kept apart from the topic it came from before anything is published.
    run = f"{ledger}/pending"
    letters.write.mode("overwrite").parquet(run)
    chosen = spark.read.parquet(run)
    again = chosen.select("key", "value", "partition", "offset", "timestamp")
    if not topics.brokers:  # a broker gives positions itself
        again = _repositioned(spark, topics, target, chosen)
    topics.append(again, target, ordered=True)
    chosen.select(*LEDGER).write.mode("append").parquet(f"{ledger}/done")
    return chosen


def _repositioned(spark: SparkSession, topics: Topics, target: str, messages: DataFrame) -> DataFrame:
    """Messages with offsets behind all of the topic's, so that a message that is rejected again
    is another letter; their order stays."""
    behind = None
    if _exists(spark, topics.path(target)):
        behind = topics.table(spark, target).agg(F.max("offset")).first()[0]
    ranked = running_totals(messages, ["partition", "offset", "source"], {"rank": F.lit(1)}, True)
    return ranked.select(
        "key", "value", "partition", (F.col("rank") + (behind or 0)).alias("offset"), "timestamp"
    )


def _ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    return spark.read.parquet(f"{ledger}/done") if _exists(spark, f"{ledger}/done") else None


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
