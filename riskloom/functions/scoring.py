"""Rules, logistic model and their combination as pure column expressions."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import (
    DEFAULTS,
    FEATURE_NAMES,
    MAX_RULE_SCORE,
    RISKY_AMOUNT,
    RISKY_CATEGORIES,
    RULE_WEIGHTS,
    SCHEMA_VERSION,
    Artifact,
    Settings,
    published_artifact,
)
from riskloom.functions.shape import without_nulls


def risky_merchant(category: Column) -> Column:
    return category.isin(*RISKY_CATEGORIES)


def rule_conditions(settings: Settings = DEFAULTS) -> dict[str, Column]:
    """Condition per rule, in the order in which rule names are reported."""
    conditions = {
        "high_amount": F.col("amount") >= settings.high_amount_threshold,
        "high_velocity": F.col("transaction_count_5m") >= settings.velocity_count_threshold,
        "new_device": F.col("is_new_device"),
        "new_country": F.col("is_new_country"),
        "risky_merchant_amount": F.col("is_risky_merchant") & (F.col("amount") >= RISKY_AMOUNT),
    }
    return {name: conditions[name] for name in RULE_WEIGHTS}


def triggered_rules(settings: Settings = DEFAULTS) -> Column:
    names = [F.when(hit, F.lit(name)) for name, hit in rule_conditions(settings).items()]
    return without_nulls(*names)


def rule_score(settings: Settings = DEFAULTS) -> Column:
    points = [
        F.when(hit, RULE_WEIGHTS[name]).otherwise(0)
        for name, hit in rule_conditions(settings).items()
    ]
    total = reduce(lambda left, right: left + right, points)
    return F.least(F.lit(MAX_RULE_SCORE), total).cast("int")


def outcome(score: Column, settings: Settings = DEFAULTS) -> Column:
    return (
        F.when(score >= settings.decline_score_threshold, "decline")
        .when(score >= settings.review_score_threshold, "review")
        .otherwise("approve")
    )


def feature_values() -> dict[str, Column]:
    """The model inputs by contract name, as doubles and in contract order."""
    values = {"log_amount": F.log1p("amount")}
    for name in FEATURE_NAMES[1:]:
        values[name] = F.col(name).cast("double")
    return values


def feature_vector() -> Column:
    return F.array(*feature_values().values())


def raw_logit(artifact: Artifact) -> Column:
    terms = [
        F.lit(weight) * ((value - F.lit(mean)) / F.lit(scale))
        for weight, value, mean, scale in zip(
            artifact.coefficients,
            feature_values().values(),
            artifact.scaler_mean,
            artifact.scaler_scale,
            strict=True,
        )
    ]
    return F.lit(artifact.intercept) + reduce(lambda left, right: left + right, terms)


def calibrated(logit: Column, artifact: Artifact) -> Column:
    calibration = artifact.calibration
    if calibration and calibration.get("method") == "platt":
        return F.lit(float(calibration["a"])) * logit + F.lit(float(calibration["b"]))
    return logit


def sigmoid(z: Column) -> Column:
    """exp is only ever taken of a non-positive number, so nothing overflows."""
    shrunk = F.exp(-F.abs(z))
    return F.when(z >= 0, 1 / (1 + shrunk)).otherwise(shrunk / (1 + shrunk))


def combined_score(rule: Column, probability: Column) -> Column:
    """The larger of both scores; rint rounds halves to the even neighbour."""
    return F.greatest(rule, F.rint(probability * 100).cast("int"))


def with_probability(features: DataFrame, artifact: Artifact) -> DataFrame:
    """Adds logit and fraud_probability; the logit is a column so it is computed once."""
    return features.withColumn("logit", calibrated(raw_logit(artifact), artifact)).withColumn(
        "fraud_probability", sigmoid(F.col("logit"))
    )


def with_scores(
    features: DataFrame, settings: Settings = DEFAULTS, artifact: Artifact | None = None
) -> DataFrame:
    """Rules, probability, combined score and decision next to the feature columns."""
    artifact = artifact or published_artifact()
    return (
        with_probability(features, artifact)
        .withColumns(
            {"triggered_rules": triggered_rules(settings), "rule_risk_score": rule_score(settings)}
        )
        .withColumn(
            "risk_score", combined_score(F.col("rule_risk_score"), F.col("fraud_probability"))
        )
        .withColumn("decision", outcome(F.col("risk_score"), settings))
    )


def feature_struct() -> Column:
    return F.struct(
        F.col("amount"),
        F.col("transaction_count_5m").cast("int").alias("transaction_count_5m"),
        F.col("is_new_device"),
        F.col("is_new_country"),
        F.col("is_risky_merchant"),
    )


DECISION_COLUMNS = (
    "schema_version",
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
    "features",
    "detector_version",
    "processed_at",
    "simulation_is_fraud",
)


def decision_records(
    scored: DataFrame,
    artifact: Artifact | None = None,
    processed_at: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Scored rows as decision records; `label` only travels along, it is never an input."""
    artifact = artifact or published_artifact()
    return scored.withColumns(
        {
            "schema_version": F.lit(SCHEMA_VERSION),
            "features": feature_struct(),
            "detector_version": F.lit(artifact.detector_version),
            "processed_at": F.current_timestamp() if processed_at is None else processed_at,
            "simulation_is_fraud": F.col("label"),
        }
    ).select(*DECISION_COLUMNS, *keep)
