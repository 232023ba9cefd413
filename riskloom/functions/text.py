"""Text forms of decisions for people and logs."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_text(value: Column) -> Column:
    """Shortest decimal text: positional from 1e-4 up to 1e16, exponent form outside."""
    java = value.cast("string")
    size = F.abs(value)
    positional = F.regexp_replace(
        value.cast("decimal(38,17)").cast("string"), r"(\.[0-9]+?)0+$", "$1"
    )
    short = F.regexp_replace(java, r"\.0E", "E")
    signed = F.regexp_replace(F.regexp_replace(short, r"E(?=[0-9])", "e+"), "E", "e")
    exponent = F.regexp_replace(signed, r"(?<=e[+-])(?=[0-9]$)", "0")
    plain = (size >= 1e-3) & (size < 1e7) | (value == 0)
    return (
        F.when(plain, java).when((size >= 1e-4) & (size < 1e16), positional).otherwise(exponent)
    )


def alert_line() -> Column:
    """One searchable line per alert, built from decision columns."""
    return F.concat(
        F.lit("FRAUD_ALERT transaction_id="),
        F.col("transaction_id"),
        F.lit(" customer_id="),
        F.col("customer_id"),
        F.lit(" decision="),
        F.col("decision"),
        F.lit(" risk_score="),
        F.col("risk_score").cast("string"),
        F.lit(" amount="),
        float_text(F.col("amount")),
        F.lit(" "),
        F.col("currency"),
        F.lit(" rules="),
        F.array_join("triggered_rules", ","),
    )
