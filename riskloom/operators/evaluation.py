"""Quality of scores against labels.

Input everywhere: rows with `fraud_probability` and a boolean `label`, null labels
are ignored.  Rank-based measures first count rows per distinct score and then use running totals
or narrow ranges of scores, so neither many equal scores nor many distinct ones end up in one task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordering import running_totals
from riskloom.operators.selection import values_at
from riskloom.session import stored

# The tolerances of the artifact comparison.
PARAM_REL_TOL = 1e-5
PARAM_ABS_TOL = 1e-7
METRIC_ABS_TOL = 5e-3
CONFUSION_COUNT_TOL = 10


def labelled(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("label").isNotNull()).select("fraud_probability", "label")


def score_counts(scored: DataFrame) -> DataFrame:
    return (
        labelled(scored)
        .groupBy(F.col("fraud_probability").alias("score"))
        .agg(F.count_if("label").alias("pos"), F.count_if(~F.col("label")).alias("neg"))
    )


def ranking_quality(scored: DataFrame) -> DataFrame:
    """ROC AUC with half credit for ties, and average precision as the step sum."""
    ranked = running_totals(
        score_counts(scored), ["score"], {"pos_upto": F.col("pos"), "neg_upto": F.col("neg")}
    )
    # One row of sums; what needs the overall totals is written so they factor out:
    # positives above a score = all positives - positives up to it.
    pos, neg, pos_upto = F.col("pos"), F.col("neg"), F.col("pos_upto").cast("double")
    totals = ranked.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    all_pos, all_neg = F.lit(float(totals.p or 0)), F.lit(float(totals.n or 0))
    above = all_pos - pos_upto
    at_or_above = above + pos + all_neg - F.col("neg_upto") + neg
    return ranked.agg(
        F.sum(neg * (above + pos / 2)).alias("area"),
        F.sum(pos * (above + pos) / at_or_above).alias("steps"),
    ).select(
        F.when((all_pos > 0) & (all_neg > 0), F.col("area") / F.nullif(all_pos * all_neg, F.lit(0.0)))
        .alias("roc_auc"),
        F.when(all_pos > 0, F.col("steps") / F.nullif(all_pos, F.lit(0.0))).otherwise(0.0)
        .alias("average_precision"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def threshold_quality(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Confusion cells, precision, recall (0 when undefined) and Brier score, in one pass."""
    p, y = F.col("fraud_probability"), F.col("label")
    hit = p >= threshold
    cells = labelled(scored).agg(
        F.count_if(~hit & ~y).alias("true_negative"),
        F.count_if(hit & ~y).alias("false_positive"),
        F.count_if(~hit & y).alias("false_negative"),
        F.count_if(hit & y).alias("true_positive"),
        F.avg(F.pow(p - y.cast("double"), F.lit(2.0))).alias("brier_score"),
    )
    tp = F.col("true_positive")
    return cells.withColumns(
        {
            "precision": _ratio(tp, tp + F.col("false_positive")),
            "recall": _ratio(tp, tp + F.col("false_negative")),
        }
    )


def holdout_report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Sizes and all measures of one slice, in one row; `scored` is read twice."""
    quality = threshold_quality(scored, threshold).withColumn("one", F.lit(1))
    ranking = ranking_quality(scored).withColumn("one", F.lit(1))
    positives = F.col("true_positive") + F.col("false_negative")
    return quality.join(ranking, "one").select(
        (positives + F.col("true_negative") + F.col("false_positive")).alias("holdout_samples"),
        positives.alias("positives"), "roc_auc", "average_precision", "precision", "recall", "brier_score",
    )


def quantile_edges(counts: DataFrame, bins: int) -> list[float]:
    """Inner bin edges of stored score counts, linearly interpolated between neighbours.

    Returns at most 2 * (bins - 1) numbers to the driver, whatever the table's size.
    """
    n = F.col("pos") + F.col("neg")
    total = counts.agg(F.sum(n)).first()[0]
    if not total:
        return []
    places = [(total - 1) * i / bins for i in range(1, bins)]
    ranks = sorted({rank for h in places for rank in (int(h), min(int(h) + 1, total - 1))})
    at = values_at(
        counts, [], F.col("score"), {f"r{rank}": lambda size, rank=rank: F.lit(rank) for rank in ranks}, weight=n
    ).first()
    edges = []
    for h in places:
        low, high = at[f"r{int(h)}"], at[f"r{min(int(h) + 1, total - 1)}"]
        share = h - int(h)
        near_low, near_high = low + (high - low) * share, high - (high - low) * (1 - share)
        edges.append(near_low if share < 0.5 else near_high)
    return edges


def reliability(scored: DataFrame, bins: int = 5) -> DataFrame:
    """Mean predicted and observed rate per quantile bin; empty bins do not appear."""
    counts = stored(score_counts(scored))
    edges = quantile_edges(counts, bins)
    n = F.col("pos") + F.col("neg")
    bin_number = F.lit(0)
    for edge in edges:
        # Right-closed: a score equal to an edge belongs to the bin below it.
        bin_number = bin_number + F.when(F.col("score") > edge, 1).otherwise(0)
    return (
        counts.groupBy(bin_number.alias("bin"))
        .agg(
            F.sum(n).alias("transactions"),
            (F.sum(F.col("score") * n) / F.sum(n)).alias("mean_predicted"),
            (F.sum("pos") / F.sum(n)).alias("observed_rate"),
        )
    )


# --- artifacts as rows ---------------------------------------------------------------------------

ARTIFACT_ROWS = "field string, position int, kind string, text string, number double"
# The fields of an artifact, by the way they are compared.
CONTRACT = ("artifact_version", "model_version", "feature_names", "decision_threshold")
TRAINING = ("samples", "fraud_rate", "seed", "split", "training_data_start")
VECTORS = ("scaler_mean", "scaler_scale", "coefficients")
METRICS = ("roc_auc", "average_precision", "precision_at_0_5", "recall_at_0_5")
CELLS = ("true_negative", "false_positive", "false_negative", "true_positive")


def artifact_rows(document: dict) -> list[tuple]:
    """(field, position, kind, text, number) per compared value of one artifact."""

    def exact(field, value):
        return (field, 0, "exact", str(value), None)

    def close(field, value, kind, position=0):
        return (field, position, kind, None, float(value))

    training = document["training"]
    metrics = training["metrics"]
    rows = [exact(name, document[name]) for name in CONTRACT]
    rows += [exact(f"training.{name}", training[name]) for name in TRAINING]
    rows += [
        close(name, x, "parameter", i) for name in VECTORS for i, x in enumerate(document[name])
    ]
    rows.append(close("intercept", document["intercept"], "parameter"))
    # A test slice without fraud has no ROC AUC.
    known = [name for name in METRICS if metrics[name] is not None]
    rows += [close(f"training.metrics.{name}", metrics[name], "metric") for name in known]
    cells = metrics["confusion_matrix"]
    rows += [close(f"training.metrics.confusion_matrix.{c}", cells[c], "count") for c in CELLS]
    calibration = document.get("calibration")
    if calibration is not None:
        rows.append(exact("calibration.method", calibration.get("method")))
        rows += [close(f"calibration.{key}", calibration[key], "parameter") for key in ("a", "b")]
    return rows


def artifact_differences(
    committed: DataFrame, candidate: DataFrame, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Fields in which two artifacts disagree beyond tolerance.

    Both sides are tables of `artifact_rows`; with `keys` many pairs are compared at once.
    A value that only one side has is a difference; for the calibration that is reported
    once, as its presence.
    """
    on = [*keys, "field", "position"]
    left = committed.select(*on, "kind", F.struct("text", "number").alias("old"))
    right = candidate.select(*on, F.col("kind").alias("kind_"), F.struct("text", "number").alias("new"))
    old, new = F.col("old.number"), F.col("new.number")
    gap = F.abs(old - new)
    kind = F.coalesce("kind", "kind_")
    reach = F.greatest(
        F.lit(PARAM_REL_TOL) * F.greatest(F.abs(old), F.abs(new)), F.lit(PARAM_ABS_TOL)
    )
    agree = (
        F.when(kind == "exact", F.col("old.text") == F.col("new.text"))
        .when(kind == "parameter", gap <= reach)
        .when(kind == "metric", gap <= METRIC_ABS_TOL)
        .when(kind == "count", gap <= CONFUSION_COUNT_TOL)
    )
    one_sided = F.col("old").isNull() | F.col("new").isNull()
    calibration = F.col("field").startswith("calibration.")
    field = F.when(one_sided & calibration, F.lit("calibration presence")).otherwise(F.col("field"))
    wording = F.when(kind == "exact", " differs").otherwise(" differs beyond tolerance")
    wording = F.when(one_sided & calibration, " differs").otherwise(wording)
    return (
        left.join(right, on, "full_outer")
        .where(one_sided | ~F.coalesce(agree, F.lit(False)))
        .select(*keys, F.concat(field, wording).alias("difference"))
        .distinct()
    )
