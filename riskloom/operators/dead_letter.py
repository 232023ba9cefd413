"""Rejected messages: how they are written, inspected and replayed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import ERROR_TEXT_LENGTH


def _header(name: str, text: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), text.cast("binary").alias("value"))


def dead_letters(
    rejected: DataFrame,
    source: str | None = None,
    error: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Key and body unchanged; what went wrong, and who found it, as headers."""
    text = F.lit(error) if error else F.array_join("errors", "; ")
    headers = [_header("error", F.left(text, F.lit(ERROR_TEXT_LENGTH)))]
    if source:
        headers.append(_header("source", F.lit(source)))
    return rejected.select("key", "value", F.array(*headers).alias("headers"), *keep)


def header(name: str) -> Column:
    """The text of one header, null when the message has none of that name."""
    found = F.filter("headers", lambda h: h["key"] == name)
    return F.get(found, F.lit(0))["value"].cast("string")


def profile(letters: DataFrame) -> DataFrame:
    """What is queued, by finder and error."""
    return letters.groupBy(
        F.coalesce(header("source"), F.lit("detector")).alias("source"),
        header("error").alias("error"),
    ).agg(F.count("*").alias("messages"))


def replayable(letters: DataFrame, limit: int = 0, source: str | None = None) -> DataFrame:
    """Messages to publish again, headers dropped; `limit` 0 takes everything queued.

    `source` keeps the letters of one finder ("detector" for those without the header):
    an undelivered alert sent to the raw topic would only be rejected again.
    """
    finder = F.coalesce(header("source"), F.lit("detector"))
    if source:
        letters = letters.where(finder == source)
    if limit:
        letters = letters.orderBy("offset").limit(limit)
    place = [c for c in ("topic", "partition", "offset", "timestamp") if c in letters.columns]
    return letters.select("key", "value", *place, finder.alias("source"))


def reject_reasons(rejected: DataFrame) -> DataFrame:
    return (
        rejected.select(F.explode("errors").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("transactions"))
    )
