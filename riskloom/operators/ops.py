"""Operations views over the decision table.

Each function takes decisions: the whole table, or `latest_n` of it as a dashboard does.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns of the published views.
LATEST_COLUMNS = (
    "transaction_id",
    "customer_id",
    "event_time",
    "amount",
    "currency",
    "risk_score",
    "rule_risk_score",
    "fraud_probability",
    "decision",
    "triggered_rules",
    "detector_version",
    "processed_at",
    "simulation_is_fraud",
)
QUEUE_COLUMNS = (
    "event_time",
    "transaction_id",
    "customer_id",
    "amount",
    "currency",
    "risk_score",
    "rule_risk_score",
    "fraud_probability",
    "decision",
    "triggered_rules",
    "detector_version",
)
LOOKUP_COLUMNS = (
    "decision",
    "risk_score",
    "rule_risk_score",
    "fraud_probability",
    "detector_version",
)


def flagged() -> Column:
    return F.col("decision") != "approve"


def latest_n(decisions: DataFrame, n: int = 2_000) -> DataFrame:
    return (
        decisions.select(*LATEST_COLUMNS)
        .orderBy(F.desc("event_time"), "transaction_id")
        .limit(n)
    )


def alerts(decisions: DataFrame) -> DataFrame:
    return decisions.where(flagged())


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))


def ops_summary(decisions: DataFrame) -> DataFrame:
    """Count, alert rate, declines and recall on labelled rows, in one pass."""
    fraud = F.col("simulation_is_fraud")
    return decisions.agg(
        F.count("*").alias("transactions"),
        F.count_if(flagged()).alias("alerts"),
        F.count_if(F.col("decision") == "decline").alias("declined"),
        F.count_if(fraud).alias("labelled_fraud"),
        F.count_if(fraud & flagged()).alias("detected_fraud"),
    ).select(
        "transactions",
        _percent(F.col("alerts"), F.col("transactions")).alias("alert_rate"),
        "declined",
        _percent(F.col("detected_fraud"), F.col("labelled_fraud")).alias("recall"),
    )


def decision_mix(decisions: DataFrame) -> DataFrame:
    return (
        decisions.groupBy("decision")
        .agg(F.count("*").alias("transactions"))
        .orderBy(F.desc("transactions"), "decision")
    )


def volume_by_minute(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy(F.date_trunc("minute", "event_time").alias("minute"), "decision").agg(
        F.count("*").alias("transactions")
    )


def investigation_queue(decisions: DataFrame) -> DataFrame:
    """Flagged decisions, newest first, rules as one text."""
    return (
        alerts(decisions)
        .select(*QUEUE_COLUMNS)
        .withColumn("triggered_rules", F.array_join("triggered_rules", ", "))
        .orderBy(F.desc("event_time"), "transaction_id")
    )


def decision_lookup(decisions: DataFrame, transaction_id: str | Column) -> DataFrame:
    """The decision of one transaction; the filter reaches the table scan."""
    return decisions.where(F.col("transaction_id") == transaction_id).select(*LOOKUP_COLUMNS)
