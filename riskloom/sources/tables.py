"""Turns the driver's `events` table into transactions and the tables derived from them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import prepare

EPOCH_2024_US = 1_704_067_200_000_000
TIME_COMPRESSION = 250
# Rows that one task reads, decodes and scores, and how far the largest piece may be above its share.
ROWS_PER_PIECE = 250_000
UNEVEN = 1.5

CATEGORY_OF_EVENT = {
    "purchase": "electronics",
    "click": "digital_goods",
    "view": "grocery",
    "signup": "travel",
    "error": "dining",
}
# Home country by user_id mod 4: code, currency, city, latitude, longitude.
PLACES = (
    ("US", "USD", "Boston", 42.36, -71.06),
    ("CA", "CAD", "Toronto", 43.65, -79.38),
    ("GB", "GBP", "London", 51.51, -0.13),
    ("DE", "EUR", "Berlin", 52.52, 13.41),
)
CHANNEL_OF_K = ("card_present", "ecommerce", "mobile")


def _pick(values, index: Column) -> Column:
    """values[index] as a CASE over literals, so it stays in generated code."""
    choice = None
    for position, value in enumerate(values):
        hit = index == position
        choice = F.when(hit, F.lit(value)) if choice is None else choice.when(hit, F.lit(value))
    return choice


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, in pieces small enough for what is done with a row, and as many as there are cores.

    How a file can be cut depends on its row groups, so many pieces of a file may be empty and one hold most rows.
    Their rows are therefore counted, which reads the files' footers only, and dealt anew unless they are even.
    """
    prepare(spark)
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    sizes = table.groupBy(F.spark_partition_id().alias("piece")).count()
    rows, largest = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    pieces = max(cores, -(-rows // ROWS_PER_PIECE))
    if largest * pieces > UNEVEN * rows:
        return table.repartition(pieces, "event_id")
    return table


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions, valid and invalid, with `seq` as the arrival number."""
    source = events(spark, sf_dir).select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.expr(
            "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) "
            f"div {TIME_COMPRESSION}"
        ).alias("tm"),
    )
    k = F.col("k")
    home = F.col("user_id") % 4
    place = F.when(k.between(50, 52), (home + 1) % 4).otherwise(home)
    category = None
    for event_type, name in CATEGORY_OF_EVENT.items():
        hit = F.col("event_type") == event_type
        category = F.when(hit, name) if category is None else category.when(hit, name)
    # One projection per layer: later columns refer to earlier ones by name.
    placed = source.withColumns(
        {
            "place": place,
            "merchant_category": category,
            "gross": F.round(F.col("value") * 20, 2),
        }
    )
    place = F.col("place")
    amount = F.when(k == 13, -F.col("gross")).otherwise(F.col("gross"))
    user = F.col("user_id").cast("string")
    number = F.col("event_id").cast("string")
    digits = F.lpad(number, 19, "0")
    return placed.select(
        F.col("event_id").alias("seq"),
        F.lit("1.0").alias("schema_version"),
        # All 19 digits that an event id can have, in the places of a UUID that are free.
        F.concat(
            F.lit("00000000-"),
            F.substring(digits, 1, 4),
            F.lit("-4000-8"),
            F.substring(digits, 5, 3),
            F.lit("-"),
            F.substring(digits, 8, 12),
        ).alias("transaction_id"),
        F.concat(F.lit("customer-"), user).alias("customer_id"),
        F.concat(F.lit("card-"), user).alias("card_id"),
        F.concat(F.lit("merchant-"), F.col("merchant_category")).alias("merchant_id"),
        "merchant_category",
        amount.alias("amount"),
        _pick([p[1] for p in PLACES], place).alias("currency"),
        F.when(k == 17, "USA").otherwise(_pick([p[0] for p in PLACES], place)).alias(
            "country_code"
        ),
        _pick([p[2] for p in PLACES], place).alias("city"),
        F.when(k == 21, 91.0).otherwise(_pick([p[3] for p in PLACES], place)).alias("latitude"),
        _pick([p[4] for p in PLACES], place).alias("longitude"),
        F.when(k >= 95, F.concat(F.lit("new-device-"), number))
        .otherwise(F.concat(F.lit("device-"), user))
        .alias("device_id"),
        F.concat(F.lit("198.51.100."), (k + 1).cast("string")).alias("ip_address"),
        _pick(CHANNEL_OF_K, k % 3).alias("channel"),
        F.timestamp_micros(F.col("tm") + EPOCH_2024_US).alias("event_time"),
        F.when(k % 10 != 7, (k >= 92) | ((amount >= 2500) & (k % 2 == 0))).alias("label"),
        "k",
        "user_id",
    )
