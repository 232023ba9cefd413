"""Quality measures, splits and fits against small brute-force versions."""

import random
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.config import FEATURE_NAMES, PUBLISHED_ARTIFACT, Artifact
from riskloom.operators import evaluation, training
from riskloom.operators.logistic import fit_logistic
from riskloom.operators.ordering import chunked_running, rows_at_ranks, running_totals


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "fraud_probability double, label boolean")


def sample(seed, count=300, levels=40):
    rng = random.Random(seed)
    pairs = []
    for _ in range(count):
        p = rng.randrange(levels) / levels
        pairs.append((p, rng.random() < 0.2 + 0.6 * p))
    return pairs + [(0.5, None)] * 5


def test_roc_auc_counts_pairs(spark):
    pairs = sample(1)
    pos = [p for p, y in pairs if y]
    neg = [p for p, y in pairs if y is False]
    wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    found = evaluation.ranking_quality(scored(spark, pairs)).first()
    assert found.roc_auc == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)


def test_average_precision_is_the_step_sum(spark):
    pairs = [(p, y) for p, y in sample(2) if y is not None]
    total, expected, before = sum(y for _, y in pairs), 0.0, 0
    for cut in sorted({p for p, _ in pairs}, reverse=True):
        chosen = [y for p, y in pairs if p >= cut]
        expected += (sum(chosen) - before) / total * sum(chosen) / len(chosen)
        before = sum(chosen)
    found = evaluation.ranking_quality(scored(spark, pairs)).first()
    assert found.average_precision == pytest.approx(expected, abs=1e-12)


def test_one_label_only(spark):
    found = evaluation.ranking_quality(scored(spark, [(0.1, False), (0.2, False)])).first()
    assert found.roc_auc is None and found.average_precision == 0.0


def test_threshold_quality_matches_published_cells(spark):
    cells = PUBLISHED_ARTIFACT["training"]["metrics"]["confusion_matrix"]
    kinds = {
        "true_negative": (0.1, False), "false_positive": (0.5, False),
        "false_negative": (0.1, True), "true_positive": (0.9, True),
    }
    pairs = [kinds[name] for name, count in cells.items() for _ in range(count)]
    row = evaluation.threshold_quality(scored(spark, pairs)).first()
    assert {name: row[name] for name in cells} == cells
    assert round(row.precision, 4) == 0.7896 and round(row.recall, 4) == 0.8450
    brier = sum((p - y) ** 2 for p, y in pairs) / len(pairs)
    assert row.brier_score == pytest.approx(brier, abs=1e-12)


def test_undefined_ratios_are_zero(spark):
    row = evaluation.threshold_quality(scored(spark, [(0.1, False)])).first()
    assert (row.precision, row.recall) == (0.0, 0.0)


@pytest.mark.parametrize("levels", [3, 40, 10_000])
def test_reliability_bins(spark, levels):
    pairs = [(p, y) for p, y in sample(3, levels=levels) if y is not None]
    p, y = np.array([a for a, _ in pairs]), np.array([b for _, b in pairs], dtype=float)
    edges = np.percentile(p, np.linspace(0, 100, 6))[1:-1]
    bins = np.searchsorted(edges, p)
    expected = {
        b: ((bins == b).sum(), p[bins == b].mean(), y[bins == b].mean()) for b in set(bins)
    }
    found = {r.bin: r for r in evaluation.reliability(scored(spark, pairs)).collect()}
    assert set(found) == set(expected)
    for b, (count, mean, rate) in expected.items():
        assert found[b].transactions == count
        assert found[b].mean_predicted == pytest.approx(mean)
        assert found[b].observed_rate == pytest.approx(rate)


# --- global order --------------------------------------------------------------------------------


def test_running_totals_and_ranks(spark):
    rng = random.Random(5)
    values = [(rng.randrange(50), i) for i in range(500)]
    frame = spark.createDataFrame(values, "k long, i long")
    found = running_totals(frame, ["k", "i"], {"upto": F.lit(1), "sum": F.col("k")}).collect()
    ordered, total = sorted(values), 0
    by_row = {(r.k, r.i): (r.upto, r["sum"]) for r in found}
    for place, row in enumerate(ordered, 1):
        total += row[0]
        assert by_row[row] == (place, total)
    picked = rows_at_ranks(frame, ["k", "i"], [0, 250, 499, 500]).collect()
    assert {r.position: (r.k, r.i) for r in picked} == {n: ordered[n] for n in (0, 250, 499)}


def test_chunked_running(spark):
    rng = random.Random(6)
    rows = [(rng.choice("aab"), i, rng.randrange(100)) for i in range(300)]
    frame = spark.createDataFrame(rows, "k string, i long, v long").withColumn(
        "chunk", F.expr("i div 17")
    )
    running = {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "l": ("min", F.col("v"))}
    found = chunked_running(frame, ["k"], "chunk", ["i"], running).collect()
    for r in found:
        past = [v for k, i, v in rows if k == r.k and i <= r.i]
        assert (r.s, r.m, r.l) == (sum(past), max(past), min(past))


# --- training ------------------------------------------------------------------------------------


def feature_rows(count, seed=7):
    rng = random.Random(seed)
    start = datetime(2026, 1, 1, tzinfo=UTC)
    rows = []
    for i in range(count):
        amount, visits = rng.lognormvariate(4, 1.2), 1 + rng.randrange(5)
        device, country, risky = rng.random() < 0.1, rng.random() < 0.05, rng.random() < 0.4
        z = -7 + np.log1p(amount) + 2 * device + risky
        rows.append(
            (i, start + timedelta(seconds=2 * i), float(amount), visits, device, country, risky,
             bool(rng.random() < 1 / (1 + np.exp(-z))))
        )
    return rows


FEATURE_TYPES = (
    "seq long, event_time timestamp, amount double, transaction_count_5m int, is_new_device boolean,"
    " is_new_country boolean, is_risky_merchant boolean, label boolean"
)


def newton(x, y, weight, penalty):
    """Minimises penalty/2 |w|^2 + sum of weighted log losses, intercept free."""
    design = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([penalty] * x.shape[1] + [0.0])
    w = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (weight * (p - y)) + ridge @ w
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
        w -= np.linalg.solve(hessian, gradient)
    return w


def plain_loss(x, y, weight, penalty, w):
    z = np.column_stack([x, np.ones(len(x))]) @ w
    return penalty / 2 * (w[:-1] ** 2).sum() + (weight * (np.maximum(z, 0) - y * z + np.log1p(np.exp(-abs(z))))).sum()


@pytest.mark.parametrize("case", ["mixed", "separable", "far apart", "repeated input", "constant input"])
def test_logistic_fits_reach_the_minimum(spark, case):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] + (0 if case == "separable" else 1) * rng.normal(size=300) > 0).astype(float)
    if case == "far apart":
        x[:, 0] = 1e4 * (2 * y - 1)
    elif case == "repeated input":
        x[:, 1] = x[:, 0]
    elif case == "constant input":
        x[:, 1] = 3.0
    weight = rng.uniform(0.1, 5, 300)
    rows = spark.createDataFrame(
        [(float(a), float(b), bool(c), float(d)) for (a, b), c, d in zip(x, y, weight, strict=True)],
        "a double, b double, label boolean, n double",
    ).checkpoint()
    fit = fit_logistic(rows, {"a": F.col("a"), "b": F.col("b")}, F.col("label"), F.col("n"), 0.5)
    found = np.array([*fit.weights, fit.intercept])
    design = np.column_stack([x, np.ones(300)])
    slope = design.T @ (weight * (1 / (1 + np.exp(-np.clip(design @ found, -700, 700))) - y))
    slope[:2] += 0.5 * found[:2]
    assert np.abs(slope / np.abs(design).max(axis=0)).max() < 1e-6
    least = plain_loss(x, y, weight, 0.5, found)
    for _ in range(50):
        moved = found * (1 + 1e-3 * rng.normal(size=3)) + 1e-6 * rng.normal(size=3)
        assert least <= plain_loss(x, y, weight, 0.5, moved)


def test_training_matches_newton(spark):
    rows = feature_rows(1500)
    document = training.train(spark.createDataFrame(rows, FEATURE_TYPES).checkpoint())
    x = np.array([[np.log1p(r[2]), r[3], r[4], r[5], r[6]] for r in rows], dtype=float)
    y = np.array([r[7] for r in rows], dtype=float)
    train, held = slice(0, 1050), slice(1050, 1200)
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0)
    assert document["scaler_mean"] == pytest.approx(mean, abs=1e-12)
    assert document["scaler_scale"] == pytest.approx(scale, abs=1e-12)

    share = y[train].mean()
    weight = np.where(y[train] == 1, 1 / (2 * share), 1 / (2 * (1 - share)))
    z = (x - mean) / scale
    w = newton(z[train], y[train], weight, 1.0)
    assert document["coefficients"] == pytest.approx(w[:5], rel=1e-9, abs=1e-11)
    assert document["intercept"] == pytest.approx(w[5], rel=1e-9, abs=1e-11)

    logit = z @ w[:5] + w[5]
    a, b = newton(logit[held, None], y[held], np.ones(150), 1.0)
    assert document["calibration"]["a"] == pytest.approx(a, rel=1e-9)
    assert document["calibration"]["b"] == pytest.approx(b, rel=1e-9)

    p = 1 / (1 + np.exp(-(a * logit[1200:] + b)))
    cells = document["training"]["metrics"]["confusion_matrix"]
    assert cells["true_positive"] == int(((p >= 0.5) & (y[1200:] == 1)).sum())
    assert sum(cells.values()) == 300
    assert document["training"]["samples"] == 1500
    assert document["training"]["training_data_start"] == "2026-01-01T00:00:00"
    Artifact.from_dict(document)


def test_too_few_rows(spark):
    frame = spark.createDataFrame(feature_rows(50), FEATURE_TYPES)
    with pytest.raises(ValueError, match="1000"):
        training.train(frame)


def test_split_is_by_time_then_arrival(spark):
    # Half of the rows share one instant, so the cut falls between equal times.
    at = datetime(2026, 1, 1, tzinfo=UTC)
    rows = [(i, at + timedelta(seconds=max(0, i - 60))) for i in range(100)]
    frame = spark.createDataFrame(rows[::-1], "seq long, event_time timestamp")
    found = {r.seq: r.split for r in training.with_split(frame).collect()}
    expected = ["train"] * 70 + ["calibration"] * 10 + ["test"] * 20
    assert [found[i] for i in range(100)] == expected


def test_constant_feature_scales_by_one(spark):
    frame = spark.createDataFrame([(1.0,) * 5, (3.0, 1.0, 1.0, 1.0, 1.0)],
                                  ", ".join(f"{n} double" for n in FEATURE_NAMES))
    row = training.scaler(frame).first()
    assert row.log_amount_mean == 2.0 and row.log_amount_scale == 1.0
    assert row.is_new_device_scale == 1.0


# --- comparing artifacts ---------------------------------------------------------------------------


def changed(path, value):
    """A copy of the published artifact with one value replaced."""
    import copy

    document = copy.deepcopy(PUBLISHED_ARTIFACT)
    place = document
    for key in path[:-1]:
        place = place[key]
    place[path[-1]] = value(place[path[-1]]) if callable(value) else value
    return document


METRICS = ("training", "metrics")
CHANGES = {
    "none": (PUBLISHED_ARTIFACT, []),
    "tiny coefficient": (changed(("coefficients", 0), lambda x: x + 1e-7), []),
    "metric in reach": (changed((*METRICS, "precision_at_0_5"), lambda x: x + 2e-3), []),
    "count in reach": (changed((*METRICS, "confusion_matrix", "false_positive"), lambda x: x + 1), []),
    "coefficient": (
        changed(("coefficients", 0), lambda x: x + 0.5), ["coefficients differs beyond tolerance"]
    ),
    "shorter vector": (
        changed(("scaler_mean",), lambda x: x[:4]), ["scaler_mean differs beyond tolerance"]
    ),
    "names": (changed(("feature_names",), ["label"]), ["feature_names differs"]),
    "auc": (
        changed((*METRICS, "roc_auc"), lambda x: x - 0.05),
        ["training.metrics.roc_auc differs beyond tolerance"],
    ),
    "no calibration": (changed(("calibration",), None), ["calibration presence differs"]),
    "calibration slope": (
        changed(("calibration", "a"), lambda x: x * 1.1), ["calibration.a differs beyond tolerance"]
    ),
    "seed": (changed(("training", "seed"), 1), ["training.seed differs"]),
}


@pytest.mark.parametrize("name", CHANGES)
def test_artifact_differences(spark, name):
    candidate, expected = CHANGES[name]
    sides = [
        spark.createDataFrame(evaluation.artifact_rows(d), evaluation.ARTIFACT_ROWS)
        for d in (PUBLISHED_ARTIFACT, candidate)
    ]
    found = [r.difference for r in evaluation.artifact_differences(*sides).collect()]
    assert found == expected
