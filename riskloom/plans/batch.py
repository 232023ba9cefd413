"""The batch scoring jobs: check, derive features, score, record."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import DEFAULTS, Artifact, Settings
from riskloom.functions.contract import check_transactions, decode_transactions, valid
from riskloom.functions.scoring import decision_records, with_scores
from riskloom.operators.features import with_features
from riskloom.session import stored


def score_transactions(
    txns: DataFrame,
    settings: Settings = DEFAULTS,
    artifact: Artifact | None = None,
    order: str = "event_time",
) -> DataFrame:
    """Features and scores of valid transactions, next to their own columns."""
    return with_scores(with_features(txns, settings, order), settings, artifact)


def decide(
    txns: DataFrame,
    settings: Settings = DEFAULTS,
    artifact: Artifact | None = None,
    order: str = "event_time",
    processed_at: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Decision records for typed transactions; invalid ones never touch any feature."""
    accepted = valid(check_transactions(txns))
    scored = score_transactions(accepted, settings, artifact, order)
    return decision_records(scored, artifact, processed_at, keep)


def decide_messages(
    messages: DataFrame,
    settings: Settings = DEFAULTS,
    artifact: Artifact | None = None,
    order: str = "arrival",
    processed_at: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Decision records for JSON messages, by default in the order of their offsets.

    The valid transactions are stored, since the features read them more than once and
    decoding costs more than reading them back.
    """
    accepted = valid(decode_transactions(messages)).withColumn("seq", F.col("offset"))
    scored = score_transactions(stored(accepted), settings, artifact, order)
    return decision_records(scored, artifact, processed_at, keep)
