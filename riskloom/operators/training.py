"""Fits the scaler, the logistic model and its calibration, and exports the artifact."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import FEATURE_NAMES, Artifact
from riskloom.functions.scoring import feature_values, raw_logit, with_probability
from riskloom.operators.evaluation import ranking_quality, threshold_quality
from riskloom.operators.logistic import fit_logistic
from riskloom.operators.ordering import rows_at_ranks
from riskloom.session import stored

MINIMUM_ROWS = 1_000
TRAIN_SHARE, CALIBRATION_END = 0.7, 0.8
# Fixed value: how the artifact names its split.
SPLIT_TEXT = "first 70% train, next 10% calibration, final 20% test"
INVERSE_PENALTY = 1.0


def training_set(features: DataFrame) -> DataFrame:
    """Model inputs and label of the labelled rows, with the columns that order them."""
    return features.where(F.col("label").isNotNull()).select(
        "event_time",
        "seq",
        *[value.alias(name) for name, value in feature_values().items()],
        "amount",
        "label",
    )


def split_column(rows: DataFrame, count: int | None = None) -> Column:
    """train / calibration / test by position in (event_time, seq) order, never shuffled.

    Only the two cut rows are looked up; the split itself is then a comparison, so it
    can be pushed to the rows wherever they are.  `rows` are read several times: pass a
    stored table.
    """
    n = rows.count() if count is None else count
    cuts = (int(n * TRAIN_SHARE), int(n * CALIBRATION_END))
    keys = ["event_time", "seq"]
    found = rows_at_ranks(rows.select(*keys), keys, list(cuts), is_stored=True)
    at = {
        row.position: (row.micros, row.seq)
        for row in found.select(F.unix_micros("event_time").alias("micros"), "seq", "position")
        .collect()
    }

    def before(rank: int) -> Column:
        if rank not in at:
            return F.lit(True)
        micros, seq = at[rank]
        mine = F.unix_micros("event_time")
        return (mine < micros) | ((mine == micros) & (F.col("seq") < seq))

    return (
        F.when(before(cuts[0]), "train").when(before(cuts[1]), "calibration").otherwise("test")
    )


def with_split(rows: DataFrame) -> DataFrame:
    return rows.withColumn("split", split_column(rows))


def scaler(train: DataFrame) -> DataFrame:
    """Mean and population deviation per feature in one row; no variance scales by 1."""
    means = [F.avg(name).alias(f"{name}_mean") for name in FEATURE_NAMES]
    spreads = []
    for name in FEATURE_NAMES:
        spread = F.stddev_pop(name)
        spreads.append(F.when(spread == 0, 1.0).otherwise(spread).alias(f"{name}_scale"))
    return train.agg(*means, *spreads)


def _class_counts(rows: DataFrame) -> tuple[int, int]:
    found = rows.agg(F.count_if("label").alias("p"), F.count("*").alias("n")).first()
    if found.p in (0, found.n):
        raise ValueError("a fit needs both labels")
    return found.p, found.n


def fit_balanced(train: DataFrame, mean: list[float], scale: list[float]) -> tuple[list[float], float]:
    """Logistic fit on standardised inputs, both labels carrying equal total weight."""
    p, n = _class_counts(train)
    inputs = {
        name: (F.col(name) - F.lit(m)) / F.lit(s)
        for name, m, s in zip(FEATURE_NAMES, mean, scale, strict=True)
    }
    weight = F.when(F.col("label"), n / (2.0 * p)).otherwise(n / (2.0 * (n - p)))
    fit = fit_logistic(train, inputs, F.col("label"), weight, 1 / INVERSE_PENALTY)
    return fit.weights, fit.intercept


def fit_platt(calibration: DataFrame, uncalibrated: Artifact) -> tuple[float, float]:
    """Slope and offset that map the raw logit to a calibrated one."""
    _class_counts(calibration)
    logits = calibration.select(raw_logit(uncalibrated).alias("logit"), "label")
    fit = fit_logistic(logits, {"logit": F.col("logit")}, F.col("label"), F.lit(1.0), 1 / INVERSE_PENALTY)
    return fit.weights[0], fit.intercept


def train(
    features: DataFrame,
    model_version: str = "logreg-v1",
    seed: int = 42,
    decision_threshold: float = 0.5,
) -> dict:
    """Artifact document fitted on labelled feature rows in time order.

    The inputs are stored once, with their part of the split as the folder they are in: a fit
    reads its own part in every step and nothing else.  The split is by time, so `seed` plays no
    part in the result and is only recorded.
    """
    rows = stored(training_set(features))
    size = rows.agg(
        F.count("*").alias("n"),
        F.avg(F.col("label").cast("double")).alias("rate"),
        F.min("event_time").alias("start"),
    ).first()
    if size.n < MINIMUM_ROWS:
        raise ValueError(f"{size.n} labelled rows, at least {MINIMUM_ROWS} are required")
    split = stored(rows.withColumn("split", split_column(rows, size.n)), by=["split"])
    part = {name: split.where(F.col("split") == name) for name in ("train", "calibration", "test")}

    fitted = scaler(part["train"]).first()
    mean = [fitted[f"{name}_mean"] for name in FEATURE_NAMES]
    scale = [fitted[f"{name}_scale"] for name in FEATURE_NAMES]
    coefficients, intercept = fit_balanced(part["train"], mean, scale)
    document = {
        "artifact_version": 2,
        "model_version": model_version,
        "feature_names": list(FEATURE_NAMES),
        "scaler_mean": mean,
        "scaler_scale": scale,
        "coefficients": coefficients,
        "intercept": intercept,
        "decision_threshold": decision_threshold,
    }
    a, b = fit_platt(part["calibration"], Artifact.from_dict(document))
    document["calibration"] = {"method": "platt", "a": a, "b": b}
    document["training"] = {
        "samples": size.n,
        "fraud_rate": size.rate,
        "seed": seed,
        "split": SPLIT_TEXT,
        "training_data_start": size.start.isoformat(),
        "metrics": _test_metrics(part["test"], Artifact.from_dict(document)),
    }
    return document


def _test_metrics(test: DataFrame, artifact: Artifact) -> dict:
    scored = with_probability(test, artifact)
    ranking = ranking_quality(scored).first()
    cells = threshold_quality(scored, artifact.decision_threshold).first()
    # A test slice without fraud has no ROC AUC.
    auc = None if ranking.roc_auc is None else round(ranking.roc_auc, 4)
    return {
        "roc_auc": auc,
        "average_precision": round(ranking.average_precision, 4),
        "precision_at_0_5": round(cells.precision, 4),
        "recall_at_0_5": round(cells.recall, 4),
        "confusion_matrix": {
            name: cells[name]
            for name in ("true_negative", "false_positive", "false_negative", "true_positive")
        },
    }
