"""Counters of the running system, kept by a stateful aggregation over what its jobs have published.

Every counter is counted from the topic or table that its job wrote, none from another counter: an alert that was scored
but never routed is missing from `alerts_received`, and only there.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.config import (
    SOURCE_ALERTER,
    SOURCE_DELIVERY,
    SOURCE_STORE,
    TOPIC_ALERTS,
    TOPIC_DEAD_LETTER,
    TOPIC_SCORED,
)
from riskloom.operators.dead_letter import header
from riskloom.session import prepare
from riskloom.sources.topics import Topics


def _labelled(rows: DataFrame, counter: Column | str, label: Column) -> DataFrame:
    name = F.lit(counter) if isinstance(counter, str) else counter
    return rows.select(name.alias("counter"), label.alias("label"))


def _outcome() -> Column:
    """The decision that a message names; the body is not decoded any further."""
    return F.coalesce(F.get_json_object(F.col("value").cast("string"), "$.decision"), F.lit("unreadable"))


def countable(scored: DataFrame, alerts: DataFrame, letters: DataFrame, sent: DataFrame | None = None) -> DataFrame:
    """One row (counter, label) per message of the topics and, with `sent`, per alert that was delivered or given up."""
    finder = header("source")
    failures = (
        F.when(finder == SOURCE_STORE, "store_failures")
        .when(finder.isin(SOURCE_ALERTER, SOURCE_DELIVERY), "alert_failures")
        .otherwise("detector_failures")
    )
    stage = F.when(finder == SOURCE_DELIVERY, "webhook").otherwise("validation")
    rows = (
        _labelled(scored, "detector_transactions", _outcome())
        .unionByName(_labelled(alerts, "alerts_received", _outcome()))
        .unionByName(_labelled(letters, failures, stage))
    )
    if sent is not None:
        rows = rows.unionByName(
            _labelled(sent, "alerts_dispatched", F.when(F.col("delivered"), "webhook").otherwise("dead_letter"))
        )
    return rows


def start_counters(
    spark: SparkSession,
    topics: Topics,
    folder: str,
    checkpoints: str,
    outcomes: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Topics (and delivery outcomes) -> running counters in `folder`.

    The state has one number per counter and label.  A batch writes the counters that it changed, under its own number,
    so the same batch again replaces itself.
    """
    prepare(spark)
    # Nothing counted yet is a table without rows.
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    sent = None
    if outcomes:
        reader = spark.readStream.schema("delivered boolean").option("recursiveFileLookup", "true")
        sent = reader.parquet(outcomes)
    rows = countable(*(topics.stream(spark, t) for t in (TOPIC_SCORED, TOPIC_ALERTS, TOPIC_DEAD_LETTER)), sent)
    totals = rows.groupBy("counter", "label").agg(F.count("*").alias("value"))

    def note(batch: DataFrame, number: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={number:010d}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = totals.writeStream.outputMode("update").foreachBatch(note)
    return writer.option("checkpointLocation", f"{checkpoints}/counters").trigger(**trigger).start()


def read_counters(spark: SparkSession, folder: str) -> DataFrame:
    """counter, label, value: counters only grow, so the greatest value noted is the current one."""
    noted = spark.read.schema("counter string, label string, value long").parquet(folder)
    return noted.groupBy("counter", "label").agg(F.max("value").alias("value"))
