"""Thresholds, names and the model artifact that every transform takes as arguments."""

import json
from dataclasses import dataclass
from pathlib import Path

# The message contract.
SCHEMA_VERSION = "1.0"
CURRENCIES = ("USD", "EUR", "GBP", "CAD")
CHANNELS = ("card_present", "ecommerce", "mobile")
OUTCOMES = ("approve", "review", "decline")
IDENTIFIER_LENGTH = 64
CITY_LENGTH = 100
MAX_AMOUNT = 1_000_000
ERROR_TEXT_LENGTH = 500

# Rule names, weights and the categories they look at.
RULE_WEIGHTS = {
    "high_amount": 60,
    "high_velocity": 35,
    "new_device": 20,
    "new_country": 25,
    "risky_merchant_amount": 20,
}
MAX_RULE_SCORE = 100
RISKY_CATEGORIES = ("digital_goods", "electronics")
RISKY_AMOUNT = 500
RULE_SET_VERSION = "hybrid-rules-v1"

# Topics and the labels their consumers use.
TOPIC_RAW = "transactions.raw"
TOPIC_SCORED = "transactions.scored"
TOPIC_ALERTS = "fraud.alerts"
TOPIC_DEAD_LETTER = "transactions.dead_letter"
SOURCE_STORE = "decision-store"
SOURCE_ALERTER = "alerter"
SOURCE_DELIVERY = "alerter-webhook"
DELIVERY_EXHAUSTED = "alert webhook delivery exhausted"

# Upper bounds of the probability histogram.
PROBABILITY_BUCKETS = (0.01, 0.05, 0.1, 0.25, 0.5, 0.7, 0.9, 0.99)

# The feature contract and the published model parameters.
FEATURE_NAMES = (
    "log_amount",
    "transaction_count_5m",
    "is_new_device",
    "is_new_country",
    "is_risky_merchant",
)
PUBLISHED_ARTIFACT = {
    "artifact_version": 2,
    "model_version": "logreg-v1",
    "feature_names": [
        "log_amount",
        "transaction_count_5m",
        "is_new_device",
        "is_new_country",
        "is_risky_merchant",
    ],
    "scaler_mean": [
        4.460912837906365,
        1.5856428571428571,
        0.12471428571428571,
        0.03571428571428571,
        0.5288571428571428,
    ],
    "scaler_scale": [
        1.3123470654165421,
        0.7505861620992061,
        0.3303946619621512,
        0.1855768722395567,
        0.4991665707017206,
    ],
    "coefficients": [
        1.1600642243034942,
        -0.20692321874447628,
        2.3662554254096904,
        -0.14486174723483158,
        1.3058696931868337,
    ],
    "intercept": -4.003484506486394,
    "decision_threshold": 0.5,
    "calibration": {"method": "platt", "a": 0.9662005522124963, "b": -2.532993112225255},
    "training": {
        "samples": 20000,
        "fraud_rate": 0.08,
        "seed": 42,
        "split": "first 70% train, next 10% calibration, final 20% test",
        "training_data_start": "2026-01-01T00:00:00+00:00",
        "metrics": {
            "roc_auc": 0.9903,
            "average_precision": 0.8898,
            "precision_at_0_5": 0.7896,
            "recall_at_0_5": 0.845,
            "confusion_matrix": {
                "true_negative": 3581,
                "false_positive": 77,
                "false_negative": 53,
                "true_positive": 289,
            },
        },
    },
}


@dataclass(frozen=True)
class Settings:
    """Tunable thresholds; the defaults are the ones the decisions are defined with."""

    # Thresholds of the rules, the decisions and the delivery.
    high_amount_threshold: float = 2_500
    velocity_window_seconds: int = 300
    velocity_count_threshold: int = 5
    review_score_threshold: int = 40
    decline_score_threshold: int = 70
    alert_max_attempts: int = 3
    alert_backoff_seconds: float = 0.5
    # Own values, which no result depends on.
    # A (customer, time slot) group above this many rows is spread over several tasks.
    hot_group_rows: int = 4_000_000
    # Arrival numbers per chunk when arrival order is replayed in batch.
    arrival_chunk: int = 1_000_000


DEFAULTS = Settings()


@dataclass(frozen=True)
class Artifact:
    """The numbers of one logistic model, checked before any plan is built on them."""

    model_version: str
    scaler_mean: tuple
    scaler_scale: tuple
    coefficients: tuple
    intercept: float
    decision_threshold: float
    calibration: dict | None = None

    @classmethod
    def from_dict(cls, document: dict) -> "Artifact":
        names = tuple(document["feature_names"])
        if names != FEATURE_NAMES:
            raise ValueError(f"artifact features are {names}, expected {FEATURE_NAMES}")
        vectors = {
            key: tuple(float(x) for x in document[key])
            for key in ("scaler_mean", "scaler_scale", "coefficients")
        }
        wrong = [key for key, vector in vectors.items() if len(vector) != len(FEATURE_NAMES)]
        if wrong:
            raise ValueError(f"artifact vectors of the wrong length: {wrong}")
        if min(vectors["scaler_scale"]) <= 0:
            raise ValueError("artifact scales must be above zero")
        return cls(
            model_version=document["model_version"],
            intercept=float(document["intercept"]),
            decision_threshold=float(document["decision_threshold"]),
            calibration=document.get("calibration"),
            **vectors,
        )

    @classmethod
    def load(cls, path: str | Path) -> "Artifact":
        return cls.from_dict(json.loads(Path(path).read_text(encoding="utf-8")))

    @property
    def detector_version(self) -> str:
        return f"{RULE_SET_VERSION}+{self.model_version}"


def published_artifact() -> Artifact:
    return Artifact.from_dict(PUBLISHED_ARTIFACT)


def write_artifact(document: dict, path: str | Path) -> None:
    """Check the document, then write it with sorted keys."""
    Artifact.from_dict(document)
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(document, indent=2, sort_keys=True) + "\n", encoding="utf-8")
