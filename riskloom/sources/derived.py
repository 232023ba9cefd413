"""Tables that the pipeline would see in operation, derived from the driver's events."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import TOPIC_RAW
from riskloom.functions.contract import TRANSACTION_FIELDS, check_transactions, to_message, valid
from riskloom.functions.scoring import DECISION_COLUMNS, decision_records
from riskloom.operators.monitoring import DURATION_BUCKETS, HOUR_US, INFINITE
from riskloom.operators.ops import flagged
from riskloom.operators.ordering import chunked_running
from riskloom.plans.batch import decide, score_transactions
from riskloom.session import stored
from riskloom.sources.tables import EPOCH_2024_US, events, transactions

ARRIVALS_PER_CHUNK = 100_000
HOLE_MINUTES = (60, 75)
RESTART_MINUTE = 120
DETECTOR_GROUP = "fraud-detector-v1"
# What the features, the scores and the decision records are made of.
DECISION_INPUTS = (
    "transaction_id", "customer_id", "event_time", "amount", "currency", "device_id", "country_code",
    "merchant_category", "label", "seq",
)


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON message bodies in topic shape, some of them broken or unusual.

    k = 33 cut off, 34 an unknown field, 35 no schema_version, 36 a time without zone.
    """
    txns = transactions(spark, sf_dir)
    k = F.col("k")
    zone = F.when(k == 36, "").otherwise("Z")
    time_text = F.concat(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), zone)
    version = F.when(k != 35, F.col("schema_version"))
    unknown = F.when(k == 34, "ignored")
    simulation = F.when(F.col("label").isNotNull(), F.struct(F.col("label").alias("is_fraud")))
    plain = [c for c in TRANSACTION_FIELDS if c not in ("schema_version", "event_time")]
    body = F.to_json(
        F.struct(
            version.alias("schema_version"),
            *plain,
            time_text.alias("event_time"),
            simulation.alias("simulation"),
            unknown.alias("added_later"),
        )
    )
    text = F.when(k == 33, F.left(body, F.lit(40))).otherwise(body)
    return _in_topic(txns, text)


def _in_topic(txns: DataFrame, text: Column) -> DataFrame:
    return txns.select(
        F.col("customer_id").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(TOPIC_RAW).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("seq").alias("offset"),
        F.col("event_time").alias("timestamp"),
    )


def _chosen(name: str, number: Column, others: dict) -> Column:
    """The column, or what `others` has for this number; None leaves the field out."""
    value = F.col(name)
    for fault, other in others.items():
        value = F.when(number == fault, other).otherwise(value)
    return value.alias(name)


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON bodies in topic shape; by seq mod 32, one field is broken or written unusually.

    Rules are met at their limits (a length of 64 or 100, -180 degrees, the largest amount) and broken
    just beyond them; 2, 8, 9, 11, 15 and 30 are unusual forms that the contract accepts.
    """
    txns = transactions(spark, sf_dir)
    fault = F.col("seq") % 32
    tid, customer = F.col("transaction_id"), F.col("customer_id")
    changes = {
        "schema_version": {23: "2.0"},
        "transaction_id": {
            8: F.replace(tid, F.lit("-"), F.lit("")),
            9: F.concat(F.lit("urn:uuid:"), tid),
            10: F.left(tid, F.lit(35)),
            11: None,
        },
        "customer_id": {1: "x" * 65, 2: F.concat(F.lit(" "), customer, F.lit("  "))},
        "card_id": {3: ""},
        "merchant_id": {4: "   "},
        "merchant_category": {5: "m" * 64},
        "amount": {21: 1_000_000.01, 22: 1_000_000.0},
        "currency": {12: "JPY", 13: "usd"},
        "country_code": {24: "us", 25: None},
        "city": {6: "é" * 100, 7: "é" * 101},
        "latitude": {20: -90.5},
        "longitude": {18: 180.5, 19: -180.0},
        "device_id": {26: None},
        "ip_address": {14: "256.1.1.1", 15: "2001:db8::1", 16: "1.2.3"},
        "channel": {17: "phone"},
    }
    time_text = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    simulation = F.struct(F.col("label").alias("is_fraud"))
    text = F.to_json(
        F.struct(
            *[_chosen(name, fault, others) for name, others in changes.items()],
            F.when(fault != 27, time_text).alias("event_time"),
            F.when(F.col("label").isNotNull() & (fault != 28), simulation).alias("simulation"),
        )
    )
    written = {
        28: (r"\}$", ',"simulation":"yes"}'),
        29: ('"customer_id":"[^"]*"', '"customer_id":7'),
        30: ('"amount":[^,]*', '"amount":"12.5"'),
        31: ('"amount":[^,]*', '"amount":true'),
    }
    return _in_topic(txns, _rewritten(text, fault, written))


def _rewritten(text: Column, number: Column, changes: dict[int, tuple[str, str]]) -> Column:
    out = text
    for fault, (pattern, other) in changes.items():
        out = F.when(number == fault, F.regexp_replace(text, pattern, other)).otherwise(out)
    return out


def faulty_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision messages with `seq` and `routed` (an alert); by seq mod 16, one field is broken.

    0 is as it was written, 7 lacks rule_risk_score, which has a default.
    """
    changes = {
        1: ('"risk_score":[0-9]+', '"risk_score":101'),
        2: ('"fraud_probability":[^,]+', '"fraud_probability":1.5'),
        3: ('"decision":"[a-z]+"', '"decision":"maybe"'),
        4: (r'"triggered_rules":\[[^\]]*\]', '"triggered_rules":[null]'),
        5: (r'"features":\{[^}]*\},', ""),
        6: ('"transaction_count_5m":[0-9]+', '"transaction_count_5m":0'),
        7: ('"rule_risk_score":[0-9]+,', ""),
        8: ('"currency":"[A-Z]+"', '"currency":"XXX"'),
        9: ('"transaction_id":"[^"]*"', '"transaction_id":"x"'),
        10: ('"processed_at":"[^"]*"', '"processed_at":"2024-01-01T00:00:00"'),
        11: ('"detector_version":"[^"]*",', ""),
        12: ('"risk_score":[0-9]+', '"risk_score":10.5'),
        13: ('"is_new_device":(true|false)', '"is_new_device":"maybe"'),
        14: ('"simulation_is_fraud":(true|false|null)', '"simulation_is_fraud":"often"'),
        15: ('("event_time":"[^"]*","amount":)[^,]+', '$1"abc"'),
    }
    sent = decide(transactions(spark, sf_dir), processed_at=F.col("event_time"), keep=("seq",))
    messages = to_message(
        sent.withColumn("routed", flagged()), "customer_id", DECISION_COLUMNS, keep=("seq", "routed")
    )
    text = _rewritten(F.col("value").cast("string"), F.col("seq") % 16, changes)
    return messages.withColumn("value", text.cast("binary"))


def tied_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times cut to whole minutes, so a customer has equal ones."""
    return transactions(spark, sf_dir).withColumn(
        "event_time", F.date_trunc("minute", "event_time")
    )


def disordered_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival delayed by up to 160 places; equal places are taken in event order."""
    late = F.col("k") % 5
    arrival = (F.col("seq") + 40 * late) * 5 + 4 - late
    return transactions(spark, sf_dir).withColumn("seq", arrival)


def decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions as they arrive at the store, a part of them sent twice.

    The second copy carries a risk one higher and, by k, a later (k mod 4 = 0), an
    earlier (k mod 4 = 1) or the same processed_at (k mod 8 = 2).
    """
    processed = F.timestamp_micros(F.unix_micros("event_time") + F.col("k") * 1000)
    # Stored once, without what no decision shows: the features read it twice, and checking costs more than that.
    accepted = stored(valid(check_transactions(transactions(spark, sf_dir))).select(*DECISION_INPUTS, "k"))
    sent = decision_records(score_transactions(accepted), processed_at=processed, keep=("seq", "k"))
    k = F.col("k")
    shift_us = F.when(k % 4 == 0, 1_000_000).when(k % 4 == 1, -1_000_000).when(k % 8 == 2, 0)
    copies = F.when(shift_us.isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    again = F.col("copy") == 1
    moved = F.timestamp_micros(F.unix_micros("processed_at") + shift_us)
    return sent.withColumn("copy", F.explode(copies)).select(
        *[c for c in sent.columns if c not in ("risk_score", "processed_at", "seq", "k")],
        F.when(again, F.least(F.lit(100), F.col("risk_score") + 1))
        .otherwise(F.col("risk_score"))
        .alias("risk_score"),
        F.when(again, moved).otherwise(F.col("processed_at")).alias("processed_at"),
        (F.col("seq") * 2 + F.col("copy")).alias("arrival"),
        "k",
    )


def offset_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One offset sample per event: the partition's end and the group's commit."""
    source = transactions(spark, sf_dir).select(
        F.lit(DETECTOR_GROUP).alias("group"),
        F.lit(TOPIC_RAW).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        "seq",
        F.col("event_time").alias("sampled_at"),
        "k",
        F.expr(f"seq div {ARRIVALS_PER_CHUNK}").alias("chunk"),
    )
    ends = chunked_running(source, ["partition"], "chunk", ["seq"], {"high": ("sum", F.lit(1))})
    committed = F.when(F.col("k") == 99, -1).otherwise(F.col("high") - F.col("k") * 20)
    return ends.withColumn("committed", committed).drop("k", "chunk")


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample per minute of three counters: metric, label, value, sampled_at.

    Nothing is scored in minutes 60 to 74, and all counters restart at minute 120.
    """
    checked = check_transactions(transactions(spark, sf_dir))
    minute = F.expr(f"(unix_micros(event_time) - {EPOCH_2024_US}) div 60000000")
    failed = F.size("errors") > 0
    scored = ~failed & ~minute.between(HOLE_MINUTES[0], HOLE_MINUTES[1] - 1)
    per_minute = checked.groupBy(minute.alias("minute")).agg(
        F.count("*").alias("accepted"),
        F.count_if(scored).alias("scored"),
        F.count_if(failed).alias("failed"),
    )
    long = per_minute.select(
        "minute",
        F.expr(
            "stack(3, 'api_transactions', 'accepted', accepted,"
            " 'detector_transactions', 'scored', scored,"
            " 'detector_failures', 'validation', failed) AS (metric, label, added)"
        ),
    )
    return _counters(long, ["metric", "label"])


def _counters(growth: DataFrame, keys: list[str]) -> DataFrame:
    """Running counters, sampled at the end of each `minute`, of what was `added` in it.

    Stored like a metric history would be: a few rows per minute of the whole table.
    """
    timed = growth.withColumns(
        {
            "life": (F.col("minute") >= RESTART_MINUTE).cast("int"),
            "at": F.lit(EPOCH_2024_US) + (F.col("minute") + 1) * 60_000_000,
        }
    )
    hourly = timed.withColumn("hour", F.expr(f"at div {HOUR_US}"))
    samples = chunked_running(
        hourly, [*keys, "life"], "hour", ["at"], {"value": ("sum", F.col("added"))}
    )
    return stored(samples.select(*keys, "value", F.timestamp_micros("at").alias("sampled_at")))


def failure_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the sinks' failures: decisions that the store could not read, alerts not delivered."""
    sent = decide(transactions(spark, sf_dir), processed_at=F.col("event_time"), keep=("seq",))
    minute = F.expr(f"(unix_micros(event_time) - {EPOCH_2024_US}) div 60000000")
    per_minute = sent.groupBy(minute.alias("minute")).agg(
        F.count_if(F.col("seq") % 16 == 1).alias("unread"),
        F.count_if(F.col("decision") == "decline").alias("undelivered"),
    )
    long = per_minute.select(
        "minute",
        F.expr(
            "stack(2, 'store_failures', 'validation', unread,"
            " 'alert_failures', 'webhook', undelivered) AS (metric, label, added)"
        ),
    )
    return _counters(long, ["metric", "label"])


def bucket_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cumulative buckets of a duration histogram per route, as running counters."""
    minute = F.expr(f"(unix_micros(started_at) - {EPOCH_2024_US}) div 60000000")
    bounds = (*DURATION_BUCKETS, INFINITE)
    counts = request_log(spark, sf_dir).groupBy("route", minute.alias("minute")).agg(
        *[F.count_if(F.col("seconds") <= bound).alias(f"b{i}") for i, bound in enumerate(bounds)]
    )
    pairs = [F.struct(F.lit(bound).alias("le"), F.col(f"b{i}").alias("added")) for i, bound in enumerate(bounds)]
    return _counters(counts.select("route", "minute", F.inline(F.array(*pairs))), ["route", "le"])


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event, `value` read as milliseconds."""
    source = events(spark, sf_dir)
    started = F.expr(
        f"timestamp_micros({EPOCH_2024_US} + timestampdiff(MICROSECOND,"
        " TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) div 250)"
    )
    micros = F.rint(F.col("value") * 1000).cast("long")
    return source.select(
        F.col("event_id").alias("request_id"),
        F.col("event_type").alias("route"),
        started.alias("started_at"),
        (F.col("value") / 1000).alias("seconds"),
        micros.alias("micros"),
    ).select(
        "request_id",
        "route",
        "started_at",
        F.timestamp_micros(F.unix_micros("started_at") + F.col("micros")).alias("finished_at"),
        "seconds",
    )
