"""Rules, model and decisions on hand-made rows and published values."""

import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.config import PUBLISHED_ARTIFACT, Artifact, Settings, published_artifact, write_artifact
from riskloom.functions.scoring import outcome, with_probability, with_scores
from riskloom.functions.text import alert_line, float_text
from riskloom.operators.artifacts import load_artifact, save_artifact
from riskloom.plans.batch import decide

FEATURES = (
    "amount double, transaction_count_5m int, is_new_device boolean, is_new_country boolean, "
    "is_risky_merchant boolean"
)
# amount, count, device, country, risky, calibrated logit, probability; the last column is the
# sigmoid of the logit in plain double arithmetic (FIXTURES.md has two of them off by 1e-10).
GOLDEN = [
    (25.5, 1, False, False, False, -9.429051576427, 0.0000803489182719),
    (45.0, 1, False, False, False, -8.958027073562, 0.0001286833573557),
    (25.5, 2, True, True, False, -3.529797003851, 0.0284762031037534),
    (500.0, 1, False, False, True, -4.390827193959, 0.0122388307195104),
    (5000.0, 1, False, False, True, -2.425761659146, 0.0812292180714841),
    (3500.0, 6, True, True, True, 2.103478679784, 0.8912408285733343),
    (1000000.0, 1, False, False, False, -0.428400578346, 0.3945083232944393),
]


@pytest.mark.parametrize("row", GOLDEN)
def test_golden_probabilities(spark, row):
    frame = spark.createDataFrame([row[:5]], FEATURES)
    found = with_probability(frame, published_artifact()).first()
    assert found.logit == pytest.approx(row[5], abs=1e-11)
    assert found.fraud_probability == pytest.approx(row[6], abs=1e-13)


def score(spark, *rows, settings=Settings()):
    return with_scores(spark.createDataFrame(list(rows), FEATURES), settings).collect()


def test_rule_thresholds_are_inclusive(spark):
    low, high, risky_low, risky = score(
        spark,
        (2499.99, 1, False, False, False),
        (2500.0, 1, False, False, False),
        (499.99, 1, False, False, True),
        (500.0, 5, False, False, True),
    )
    assert low.triggered_rules == [] and low.rule_risk_score == 0
    assert high.triggered_rules == ["high_amount"] and high.rule_risk_score == 60
    assert risky_low.triggered_rules == []
    assert risky.triggered_rules == ["high_velocity", "risky_merchant_amount"]


def test_all_rules_are_capped(spark):
    (row,) = score(spark, (3000.0, 6, True, True, True))
    assert row.triggered_rules == [
        "high_amount", "high_velocity", "new_device", "new_country", "risky_merchant_amount"
    ]
    assert row.rule_risk_score == 100 and row.risk_score == 100 and row.decision == "decline"


def test_outcome_limits(spark):
    frame = spark.createDataFrame([(39,), (40,), (69,), (70,)], "s int")
    found = [r[0] for r in frame.select(outcome(F.col("s"))).collect()]
    assert found == ["approve", "review", "review", "decline"]


def test_halves_round_to_even(spark):
    frame = spark.createDataFrame([(0.025,), (0.035,)], "p double")
    found = [r[0] for r in frame.select(F.rint(F.col("p") * 100).cast("int")).collect()]
    assert found == [2, 4]


def test_extreme_logits_do_not_overflow(spark):
    steep = Artifact.from_dict(
        PUBLISHED_ARTIFACT | {"intercept": 1e6, "calibration": None}
    )
    flat = Artifact.from_dict(PUBLISHED_ARTIFACT | {"intercept": -1e6, "calibration": None})
    frame = spark.createDataFrame([(45.0, 1, False, False, False)], FEATURES)
    assert with_probability(frame, steep).first().fraud_probability == 1.0
    assert with_probability(frame, flat).first().fraud_probability == 0.0


def test_normal_transaction(make):
    row = decide(make({})).first()
    assert row.decision == "approve" and row.risk_score == 0 and row.triggered_rules == []
    assert row.detector_version == "hybrid-rules-v1+logreg-v1"
    assert row.simulation_is_fraud is None and row.processed_at is not None


def test_high_amount_at_risky_merchant(make):
    row = decide(make({"amount": 5000.0, "merchant_category": "electronics"})).first()
    assert row.decision == "decline" and row.rule_risk_score == 80 and row.risk_score >= 80
    assert row.triggered_rules == ["high_amount", "risky_merchant_amount"]


def test_velocity_rule_uses_event_time(make):
    start = datetime(2026, 1, 1, tzinfo=UTC)
    rows = make(*[{"event_time": start + timedelta(seconds=30 * i)} for i in range(3)])
    last = decide(rows, Settings(velocity_count_threshold=3), keep=("seq",)).where("seq = 2").first()
    assert last.features.transaction_count_5m == 3 and "high_velocity" in last.triggered_rules


def test_new_device_and_country_need_review(make):
    rows = make({}, {"device_id": "x", "country_code": "GB", "currency": "GBP", "city": "London"})
    last = decide(rows, keep=("seq",)).where("seq = 1").first()
    assert last.features.is_new_device and last.features.is_new_country
    assert last.decision == "review"


def test_invalid_rows_never_reach_state(make):
    rows = make({"amount": -1.0, "device_id": "x"}, {}, {"device_id": "x"})
    last = decide(rows, keep=("seq",)).where("seq = 2").first()
    assert last.features.is_new_device and last.features.transaction_count_5m == 2


def test_label_is_not_an_input(make):
    true, false = (
        decide(make({"label": value})).drop("processed_at", "simulation_is_fraud").first()
        for value in (True, False)
    )
    assert true == false


def test_alert_line(make):
    row = decide(make({"amount": 5000.0, "merchant_category": "electronics"}))
    line = row.select(alert_line()).first()[0]
    assert line == (
        "FRAUD_ALERT transaction_id=11111111-2222-4333-8444-555555555555 customer_id=customer-81 "
        "decision=decline risk_score=80 amount=5000.0 USD rules=high_amount,risky_merchant_amount"
    )


@pytest.mark.parametrize(
    "value",
    [25.5, 5000.0, 0.0005, 0.00025, 0.01, 1e6, 12345678.25, 1e7, 0.00005, 1.5e-7, 1e16, 2.5e17],
)
def test_float_text_matches_python(spark, value):
    frame = spark.createDataFrame([(value,)], "x double")
    assert frame.select(float_text(F.col("x"))).first()[0] == repr(value)


def test_artifact_contract(tmp_path):
    path = tmp_path / "m" / "artifact.json"
    write_artifact(PUBLISHED_ARTIFACT, path)
    assert Artifact.load(path) == published_artifact()
    assert list(json.loads(path.read_text())) == sorted(PUBLISHED_ARTIFACT)
    for change in (
        {"feature_names": ["label"]},
        {"coefficients": [1.0]},
        {"scaler_scale": [1, 1, 0, 1, 1]},
    ):
        with pytest.raises(ValueError):
            Artifact.from_dict(PUBLISHED_ARTIFACT | change)


def test_artifacts_on_shared_storage(spark, tmp_path):
    path = f"file://{tmp_path}/deep/model.json"
    save_artifact(spark, PUBLISHED_ARTIFACT, path)
    assert load_artifact(spark, path) == published_artifact()
    changed = PUBLISHED_ARTIFACT | {"intercept": 1.5}
    save_artifact(spark, changed, path)
    assert load_artifact(spark, path).intercept == 1.5
    # A document that breaks the contract is not written, and what is there stays.
    with pytest.raises(ValueError, match="lengths|length"):
        save_artifact(spark, PUBLISHED_ARTIFACT | {"coefficients": [1.0]}, path)
    assert load_artifact(spark, path).intercept == 1.5
    assert [p.name for p in (tmp_path / "deep").iterdir() if p.suffix == ".json"] == ["model.json"]


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ("", "not JSON"), ("[1]", "object"), ("{", "not JSON"), ('{"artifact_version": 1}', "version"),
        ('{"artifact_version": 2}', "without"),
        (json.dumps(PUBLISHED_ARTIFACT | {"scaler_mean": 3}), "type"),
        (json.dumps(PUBLISHED_ARTIFACT | {"scaler_scale": [1, 1, 1, 1, -1]}), "above zero"),
    ],
)
def test_broken_artifacts_are_refused(spark, tmp_path, text, reason):
    (tmp_path / "model.json").write_text(text)
    with pytest.raises(ValueError, match=reason):
        load_artifact(spark, str(tmp_path / "model.json"))
