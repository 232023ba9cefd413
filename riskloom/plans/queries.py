"""Registered queries, each next to the SQL it is compared with.

Every query runs over the whole `events` table of the given scale, or over tables
derived from all of it.  Probabilities and other computed doubles are rounded to nine
places on both sides, instants are shown as UTC wall-clock times.
"""

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import config
from riskloom.functions import contract, scoring
from riskloom.functions.text import alert_line
from riskloom.operators import artifacts, dead_letter, evaluation, monitoring, ops, store, training
from riskloom.operators.features import with_feature_vector, with_features
from riskloom.plans.batch import decide, decide_messages, score_transactions
from riskloom.plans.oracle import EPOCH, MODEL, newton_sql, sql
from riskloom.session import checkpoint_dir, prepare, stored
from riskloom.sources import derived
from riskloom.sources.tables import transactions
from riskloom.sources.topics import POSITION, Topics
from riskloom.streaming import jobs
from riskloom.streaming.counters import read_counters, start_counters
from riskloom.streaming.delivery import deliver_alerts
from riskloom.streaming.pipeline import start_pipeline
from riskloom.streaming.progress import batch_durations, record_progress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Instants as zone-free UTC times, the form in which SQL engines return them."""
    instants = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return _plain(function(spark, sf_dir))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def r9(column) -> F.Column:
    return F.round(column, 9)


# --- shared inputs --------------------------------------------------------------------------------


def _checked(spark, sf_dir):
    return contract.check_transactions(transactions(spark, sf_dir))


def _valid(spark, sf_dir):
    return contract.valid(_checked(spark, sf_dir))


def _features(spark, sf_dir):
    return with_features(_valid(spark, sf_dir))


def _scored(spark, sf_dir):
    return score_transactions(_valid(spark, sf_dir))


def _decisions(spark, sf_dir):
    processed = F.timestamp_micros(F.unix_micros("event_time") + F.col("k") * 1000)
    return decide(transactions(spark, sf_dir), processed_at=processed, keep=("k", "label"))


def _log(spark, sf_dir):
    return derived.decision_log(spark, sf_dir)


# --- messages: check, decode, route ---------------------------------------------------------------


@query("q_validate", sql("SELECT seq, errors FROM checked", "checked"))
def q_validate(spark, sf_dir):
    return _checked(spark, sf_dir).select("seq", F.array_join("errors", ";").alias("errors"))


VALID_COLUMNS = (
    "transaction_id", "customer_id", "card_id", "merchant_id", "merchant_category", "amount",
    "currency", "country_code", "city", "device_id", "ip_address", "channel", "event_time",
)


@query(
    "q_valid_transactions",
    sql(
        f"SELECT {', '.join(VALID_COLUMNS[:-1])}, make_timestamp(us) AS event_time FROM ok", "ok"
    ),
)
def q_valid_transactions(spark, sf_dir):
    return _valid(spark, sf_dir).select(*VALID_COLUMNS)


@query(
    "q_reject_reasons",
    sql(
        """SELECT reason, count(*) AS transactions FROM (
            SELECT unnest(string_split(errors, ';')) AS reason FROM checked WHERE errors <> '')
        GROUP BY reason""",
        "checked",
    ),
)
def q_reject_reasons(spark, sf_dir):
    return dead_letter.reject_reasons(contract.rejected(_checked(spark, sf_dir)))


DECODED_SQL = """SELECT seq AS "offset", CASE WHEN k = 33 THEN 'body:json'
        WHEN k = 36 THEN concat_ws(';', nullif(errors, ''), 'event_time:type')
        ELSE errors END AS errors,
    CASE WHEN k NOT IN (33, 36) THEN us END AS us,
    CASE WHEN k <> 33 THEN customer_id END AS customer_id,
    CASE WHEN k <> 33 THEN amount END AS amount,
    CASE WHEN k <> 33 THEN label END AS label
    FROM checked"""


@query(
    "q_decode_transactions",
    sql(
        f"""SELECT "offset", errors, make_timestamp(us) AS event_time, customer_id, amount, label
        FROM ({DECODED_SQL})""",
        "checked",
    ),
)
def q_decode_transactions(spark, sf_dir):
    decoded = contract.decode_transactions(derived.raw_messages(spark, sf_dir))
    return decoded.select(
        "offset",
        F.array_join("errors", ";").alias("errors"),
        "event_time",
        "customer_id",
        "amount",
        "label",
    )


@query(
    "q_contract_faults",
    sql(
        """SELECT seq AS "offset", errors, trim(customer_id) AS customer_id, city, amount,
            CASE WHEN fault = 11 THEN 'derived' ELSE transaction_id END AS transaction_id
        FROM refused""",
        "refused",
    ),
)
def q_contract_faults(spark, sf_dir):
    """Every rule of the contract at its limit, just beyond it, and in unusual forms."""
    decoded = contract.decode_transactions(derived.faulty_messages(spark, sf_dir))
    given = F.col("offset") % 32 != 11
    derived_id = F.when(F.col("transaction_id").rlike(contract.CANONICAL_UUID_PATTERN), "derived")
    return decoded.select(
        "offset",
        F.array_join("errors", ";").alias("errors"),
        "customer_id",
        "city",
        "amount",
        F.when(given, F.col("transaction_id")).otherwise(derived_id).alias("transaction_id"),
    )


@query(
    "q_decision_faults",
    sql(
        """SELECT seq, CASE seq % 16 WHEN 1 THEN 'risk_score:range' WHEN 2 THEN 'fraud_probability:range'
            WHEN 3 THEN 'decision:choice' WHEN 4 THEN 'triggered_rules:type' WHEN 5 THEN 'features:missing'
            WHEN 6 THEN 'features:range' WHEN 8 THEN 'currency:choice' WHEN 9 THEN 'transaction_id:type'
            WHEN 10 THEN 'processed_at:type' WHEN 11 THEN 'detector_version:missing'
            WHEN 12 THEN 'risk_score:type' WHEN 13 THEN 'features:type'
            WHEN 14 THEN 'simulation_is_fraud:type' WHEN 15 THEN 'amount:type' ELSE '' END AS errors,
            CASE WHEN seq % 16 = 7 THEN 0 ELSE rule_risk_score END AS rule_risk_score
        FROM dec""",
        "dec",
    ),
)
def q_decision_faults(spark, sf_dir):
    decoded = contract.decode_decisions(derived.faulty_decisions(spark, sf_dir))
    return decoded.select("seq", F.array_join("errors", ";").alias("errors"), "rule_risk_score")


@query(
    "q_acceptance",
    sql(
        f"""SELECT c.transaction_id, 'accepted' AS status, make_timestamp(c.us) AS accepted_at
        FROM checked c JOIN ({DECODED_SQL}) d ON c.seq = d."offset" WHERE d.errors = ''""",
        "checked",
    ),
)
def q_acceptance(spark, sf_dir):
    decoded = contract.decode_transactions(derived.raw_messages(spark, sf_dir))
    return contract.acceptance(contract.valid(decoded), F.col("timestamp"))


@query(
    "q_dead_letter_profile",
    sql(
        f"""SELECT 'detector' AS source, replace(errors, ';', '; ') AS error, count(*) AS messages
        FROM ({DECODED_SQL}) WHERE errors <> '' GROUP BY ALL""",
        "checked",
    ),
)
def q_dead_letter_profile(spark, sf_dir):
    return dead_letter.profile(_letters(spark, sf_dir))


def _letters(spark, sf_dir):
    decoded = contract.decode_transactions(derived.raw_messages(spark, sf_dir))
    return dead_letter.dead_letters(contract.rejected(decoded))


@query(
    "q_replay",
    sql(
        f"""SELECT c.customer_id AS "key", count(*) AS messages
        FROM checked c JOIN ({DECODED_SQL}) d ON c.seq = d."offset" WHERE d.errors <> ''
        GROUP BY 1""",
        "checked",
    ),
)
def q_replay(spark, sf_dir):
    replay = dead_letter.replayable(_letters(spark, sf_dir), source="detector")
    return replay.groupBy(F.col("key").cast("string").alias("key")).agg(
        F.count("*").alias("messages")
    )


@query(
    "q_replay_dry_run",
    sql(
        f"""SELECT c.customer_id AS "key", count(*) AS messages, CAST(0 AS BIGINT) AS replayed
        FROM checked c JOIN ({DECODED_SQL}) d ON c.seq = d."offset" WHERE d.errors <> ''
        GROUP BY 1""",
        "checked",
    ),
)
def q_replay_dry_run(spark, sf_dir):
    """What a replay would publish, after a first dry run that must not have published anything."""
    root = f"{checkpoint_dir(spark)}/topics-{uuid.uuid4().hex}"
    topics = Topics(root=root)
    raw = derived.raw_messages(spark, sf_dir)
    rejects = contract.rejected(contract.decode_transactions(raw))
    topics.append(dead_letter.dead_letters(rejects, keep=POSITION), config.TOPIC_DEAD_LETTER)
    topics.append(raw.limit(0), "replayed")
    for _ in range(2):
        listed = jobs.replay(spark, topics, f"{root}/ledger", target="replayed", dry_run=True)
    replayed = topics.table(spark, "replayed").count()
    return listed.groupBy(F.col("key").cast("string").alias("key")).agg(
        F.count("*").alias("messages"), F.lit(replayed).cast("long").alias("replayed")
    )


@query(
    "q_customer_partition_counts",
    sql(
        """SELECT customer_id, CAST(user_id % 3 AS INTEGER) AS "partition", count(*) AS messages,
            min(seq) AS first_offset, max(seq) AS last_offset FROM txn GROUP BY ALL""",
        "txn",
    ),
)
def q_customer_partition_counts(spark, sf_dir):
    """The raw topic as it was written: where each customer's messages are, and how far they reach."""
    root = f"{checkpoint_dir(spark)}/topics-{uuid.uuid4().hex}"
    topics = Topics(root=root)
    topics.append(derived.raw_messages(spark, sf_dir), config.TOPIC_RAW, ordered=True)
    held = topics.table(spark, config.TOPIC_RAW)
    return held.groupBy(F.col("key").cast("string").alias("customer_id"), "partition").agg(
        F.count("*").alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


# --- features ---------------------------------------------------------------------------------------


@query("q_velocity", sql("SELECT transaction_id, transaction_count_5m FROM feat", "feat"))
def q_velocity(spark, sf_dir):
    return _features(spark, sf_dir).select("transaction_id", "transaction_count_5m")


@query("q_new_device", sql("SELECT transaction_id, is_new_device FROM feat", "feat"))
def q_new_device(spark, sf_dir):
    return _features(spark, sf_dir).select("transaction_id", "is_new_device")


@query("q_new_country", sql("SELECT transaction_id, is_new_country FROM feat", "feat"))
def q_new_country(spark, sf_dir):
    return _features(spark, sf_dir).select("transaction_id", "is_new_country")


@query("q_risky_merchant", sql("SELECT transaction_id, is_risky_merchant FROM feat", "feat"))
def q_risky_merchant(spark, sf_dir):
    return _valid(spark, sf_dir).select(
        "transaction_id",
        scoring.risky_merchant(F.col("merchant_category")).alias("is_risky_merchant"),
    )


@query(
    "q_features",
    sql(
        """SELECT transaction_id, amount, transaction_count_5m, is_new_device, is_new_country,
            is_risky_merchant FROM feat""",
        "feat",
    ),
)
def q_features(spark, sf_dir):
    features = _features(spark, sf_dir)
    return features.select("transaction_id", scoring.feature_struct().alias("f")).select(
        "transaction_id", "f.*"
    )


@query(
    "q_feature_vector",
    sql(
        """SELECT transaction_id, round(x0, 9) AS log_amount, x1 AS transaction_count_5m,
            x2 AS is_new_device, x3 AS is_new_country, x4 AS is_risky_merchant FROM vec""",
        "vec",
    ),
)
def q_feature_vector(spark, sf_dir):
    vectors = with_feature_vector(_features(spark, sf_dir))
    return vectors.select(
        "transaction_id",
        *[
            r9(F.get("feature_vector", F.lit(i))).alias(name)
            for i, name in enumerate(config.FEATURE_NAMES)
        ],
    )


@query(
    "q_velocity_ties",
    sql(
        """SELECT transaction_id, CAST(count(*) OVER (PARTITION BY customer_id ORDER BY t
                RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW)
            - count(*) OVER (PARTITION BY customer_id, t)
            + row_number() OVER (PARTITION BY customer_id, t ORDER BY seq) AS INTEGER)
            AS transaction_count_5m
        FROM (SELECT *, us // 60000000 * 60000000 AS t FROM ok)""",
        "ok",
    ),
)
def q_velocity_ties(spark, sf_dir):
    tied = contract.valid(contract.check_transactions(derived.tied_transactions(spark, sf_dir)))
    return with_features(tied).select("transaction_id", "transaction_count_5m")


@query(
    "q_arrival_features",
    sql(
        """SELECT a.transaction_id, CAST(a.place - count(g.ends) AS INTEGER) AS transaction_count_5m,
            any_value(a.is_new_device) AS is_new_device,
            any_value(a.is_new_country) AS is_new_country
        FROM placed a LEFT JOIN gone g ON g.customer_id = a.customer_id AND g.ends <= a.arrival
        GROUP BY a.transaction_id, a.place""",
        "ok",
    ).replace(
        "\nSELECT a.transaction_id",
        """, placed AS (SELECT *, (seq + 40 * (k % 5)) * 5 + 4 - k % 5 AS arrival,
            row_number() OVER (PARTITION BY customer_id ORDER BY (seq + 40 * (k % 5)) * 5 + 4 - k % 5)
                AS place,
            place > 1 AND row_number() OVER (PARTITION BY customer_id, device_id
                ORDER BY (seq + 40 * (k % 5)) * 5 + 4 - k % 5) = 1 AS is_new_device,
            place > 1 AND row_number() OVER (PARTITION BY customer_id, country_code
                ORDER BY (seq + 40 * (k % 5)) * 5 + 4 - k % 5) = 1 AS is_new_country
        FROM ok),
        gone AS (SELECT a.customer_id, a.arrival, min(b.arrival) AS ends
            FROM placed a JOIN placed b ON a.customer_id = b.customer_id
                AND b.arrival > a.arrival AND b.us > a.us + 300000000
            GROUP BY ALL)
        SELECT a.transaction_id""",
    ),
)
def q_arrival_features(spark, sf_dir):
    late = derived.disordered_transactions(spark, sf_dir)
    accepted = contract.valid(contract.check_transactions(late))
    return with_features(accepted, order="arrival").select(
        "transaction_id", "transaction_count_5m", "is_new_device", "is_new_country"
    )


# --- rules, model, decisions ------------------------------------------------------------------------


@query(
    "q_rule_hits",
    sql(
        """SELECT rule, count(*) AS hits FROM (
            SELECT unnest(string_split(rules, ',')) AS rule FROM pr WHERE rules <> '')
        GROUP BY rule""",
        "pr",
    ),
)
def q_rule_hits(spark, sf_dir):
    return (
        _scored(spark, sf_dir)
        .select(F.explode("triggered_rules").alias("rule"))
        .groupBy("rule")
        .agg(F.count("*").alias("hits"))
    )


@query("q_triggered_rules", sql("SELECT transaction_id, rules AS triggered_rules FROM pr", "pr"))
def q_triggered_rules(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "transaction_id", F.array_join("triggered_rules", ",").alias("triggered_rules")
    )


@query("q_rule_score", sql("SELECT transaction_id, rule_risk_score FROM pr", "pr"))
def q_rule_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("transaction_id", "rule_risk_score")


@query(
    "q_logit",
    sql(
        """SELECT transaction_id, round(raw_logit, 9) AS raw_logit, round(logit, 9) AS logit
        FROM lg""",
        "lg",
    ),
)
def q_logit(spark, sf_dir):
    artifact = config.published_artifact()
    return (
        _features(spark, sf_dir)
        .withColumn("raw", scoring.raw_logit(artifact))
        .select(
            "transaction_id",
            r9("raw").alias("raw_logit"),
            r9(scoring.calibrated(F.col("raw"), artifact)).alias("logit"),
        )
    )


@query(
    "q_fraud_probability",
    sql("SELECT transaction_id, round(fraud_probability, 9) AS fraud_probability FROM pr", "pr"),
)
def q_fraud_probability(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "transaction_id", r9("fraud_probability").alias("fraud_probability")
    )


@query("q_risk_score", sql("SELECT transaction_id, risk_score FROM sc", "sc"))
def q_risk_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("transaction_id", "risk_score")


DECISIONS_SQL = """SELECT transaction_id, customer_id, make_timestamp(us) AS event_time, amount,
    currency, risk_score, rule_risk_score, round(fraud_probability, 9) AS fraud_probability,
    decision, rules AS triggered_rules, transaction_count_5m, is_new_device, is_new_country,
    is_risky_merchant, detector_version, label AS simulation_is_fraud FROM dec"""


def _flat(decisions):
    return decisions.select(
        "transaction_id",
        "customer_id",
        "event_time",
        "amount",
        "currency",
        "risk_score",
        "rule_risk_score",
        r9("fraud_probability").alias("fraud_probability"),
        "decision",
        F.array_join("triggered_rules", ",").alias("triggered_rules"),
        "features.transaction_count_5m",
        "features.is_new_device",
        "features.is_new_country",
        "features.is_risky_merchant",
        "detector_version",
        "simulation_is_fraud",
    )


@query("q_decisions", sql(DECISIONS_SQL, "dec"))
def q_decisions(spark, sf_dir):
    return _flat(_decisions(spark, sf_dir))


@query("q_decode_decisions", sql(DECISIONS_SQL, "dec"))
def q_decode_decisions(spark, sf_dir):
    """Decisions written as JSON messages and read back through the contract."""
    messages = contract.to_message(
        _decisions(spark, sf_dir), "customer_id", scoring.DECISION_COLUMNS
    )
    return _flat(contract.valid(contract.decode_decisions(messages)))


@query(
    "q_batch_score",
    sql(
        """SELECT seq, round(fraud_probability, 9) AS fraud_probability,
            fraud_probability >= 0.5 AS predicted, label FROM lab""",
        "lab",
    ),
)
def q_batch_score(spark, sf_dir):
    artifact = config.published_artifact()
    table = training.training_set(_features(spark, sf_dir))
    return scoring.with_probability(table, artifact).select(
        "seq",
        r9("fraud_probability").alias("fraud_probability"),
        (F.col("fraud_probability") >= artifact.decision_threshold).alias("predicted"),
        "label",
    )


# --- alerts and store -------------------------------------------------------------------------------


@query(
    "q_alert_stream",
    sql(
        """SELECT transaction_id, customer_id, decision, risk_score, rules AS triggered_rules
        FROM dec WHERE decision <> 'approve'""",
        "dec",
    ),
)
def q_alert_stream(spark, sf_dir):
    return ops.alerts(_decisions(spark, sf_dir)).select(
        "transaction_id",
        "customer_id",
        "decision",
        "risk_score",
        F.array_join("triggered_rules", ",").alias("triggered_rules"),
    )


@query(
    "q_alert_lines",
    sql(
        """SELECT 'FRAUD_ALERT transaction_id=' || transaction_id || ' customer_id=' || customer_id
            || ' decision=' || decision || ' risk_score=' || risk_score || ' amount=' || amount
            || ' ' || currency || ' rules=' || rules AS line
        FROM dec WHERE decision <> 'approve'""",
        "dec",
    ),
)
def q_alert_lines(spark, sf_dir):
    return ops.alerts(_decisions(spark, sf_dir)).select(alert_line().alias("line"))


@query(
    "q_store_rows",
    sql(
        """SELECT transaction_id, customer_id, make_timestamp(us) AS event_time,
            CAST(amount AS DECIMAL(14, 2)) AS amount, currency,
            CAST(risk_score AS SMALLINT) AS risk_score,
            CAST(rule_risk_score AS SMALLINT) AS rule_risk_score,
            round(fraud_probability, 9) AS fraud_probability, decision,
            CASE WHEN rules = '' THEN '[]' ELSE '["' || replace(rules, ',', '","') || '"]' END
                AS triggered_rules,
            '{"amount":' || amount || ',"transaction_count_5m":' || transaction_count_5m
                || ',"is_new_device":' || is_new_device || ',"is_new_country":' || is_new_country
                || ',"is_risky_merchant":' || is_risky_merchant || '}' AS features,
            detector_version, make_timestamp(processed_us) AS processed_at,
            label AS simulation_is_fraud
        FROM dec""",
        "dec",
    ),
)
def q_store_rows(spark, sf_dir):
    rows = store.as_json_columns(store.store_rows(_decisions(spark, sf_dir)))
    return rows.withColumn("fraud_probability", r9("fraud_probability")).drop("k", "label")


@query(
    "q_latest_decision",
    sql(
        """SELECT transaction_id, decision, risk_score, make_timestamp(processed_us) AS processed_at
        FROM log QUALIFY row_number() OVER (PARTITION BY transaction_id
            ORDER BY processed_us DESC, seq DESC) = 1""",
        "log",
    ),
)
def q_latest_decision(spark, sf_dir):
    columns = ["transaction_id", "decision", "risk_score", "processed_at"]
    return store.latest_decisions(stored(_log(spark, sf_dir).select(*columns, "arrival"))).select(*columns)


@query(
    "q_store_violations",
    sql(
        """SELECT transaction_id, unnest(string_split(v, ';')) AS violation FROM (
            SELECT transaction_id, concat_ws(';',
                CASE WHEN k = 8 THEN 'currency_not_null' END,
                CASE WHEN k % 10 = 0 AND risk_score + 60 > 100 THEN 'risk_score_range' END,
                CASE WHEN k = 7 THEN 'fraud_probability_range' END,
                CASE WHEN k = 5 THEN 'decision_domain' END,
                CASE WHEN k = 6 THEN 'detector_version_width' END) AS v
            FROM dec) WHERE v <> ''""",
        "dec",
    ),
)
def q_store_violations(spark, sf_dir):
    k = F.col("k")
    rows = store.store_rows(_decisions(spark, sf_dir))
    broken = rows.withColumns(
        {
            "risk_score": F.col("risk_score") + F.when(k % 10 == 0, 60).otherwise(0),
            "decision": F.when(k == 5, "block").otherwise(F.col("decision")),
            "detector_version": F.when(k == 6, F.repeat("detector_version", F.lit(3))).otherwise(
                F.col("detector_version")
            ),
            "fraud_probability": F.when(k == 7, -1.0).otherwise(F.col("fraud_probability")),
            "currency": F.when(k != 8, F.col("currency")),
        }
    )
    return store.violations(broken)


@query(
    "q_store_migrated",
    sql(
        """SELECT transaction_id, risk_score,
            CAST(CASE WHEN k < 50 THEN 0 ELSE rule_risk_score END AS SMALLINT) AS rule_risk_score
        FROM dec""",
        "dec",
    ),
)
def q_store_migrated(spark, sf_dir):
    rows = store.store_rows(_decisions(spark, sf_dir)).select(
        "transaction_id", F.col("risk_score").cast("int").alias("risk_score"), "rule_risk_score", "k"
    )
    older = rows.where(F.col("k") < 50).drop("rule_risk_score")
    return store.join_versions(older, rows.where(F.col("k") >= 50)).drop("k")


# --- operations views --------------------------------------------------------------------------------


@query(
    "q_latest_n",
    sql(
        """SELECT transaction_id, customer_id, make_timestamp(us) AS event_time, amount, currency,
            risk_score, rule_risk_score, round(fraud_probability, 9) AS fraud_probability, decision,
            rules AS triggered_rules, detector_version,
            make_timestamp(processed_us) AS processed_at, label AS simulation_is_fraud
        FROM dec ORDER BY us DESC, transaction_id LIMIT 2000""",
        "dec",
    ),
)
def q_latest_n(spark, sf_dir):
    return ops.latest_n(_decisions(spark, sf_dir)).withColumns(
        {
            "fraud_probability": r9("fraud_probability"),
            "triggered_rules": F.array_join("triggered_rules", ","),
        }
    )


@query(
    "q_ops_summary",
    sql(
        """SELECT count(*) AS transactions,
            round(100.0::DOUBLE * count(*) FILTER (WHERE decision <> 'approve') / count(*), 9)
                AS alert_rate,
            count(*) FILTER (WHERE decision = 'decline') AS declined,
            round(coalesce(100.0::DOUBLE * count(*) FILTER (WHERE label AND decision <> 'approve')
                / nullif(count(*) FILTER (WHERE label), 0), 0), 9) AS recall
        FROM dec""",
        "dec",
    ),
)
def q_ops_summary(spark, sf_dir):
    return ops.ops_summary(_decisions(spark, sf_dir)).withColumns(
        {"alert_rate": r9("alert_rate"), "recall": r9("recall")}
    )


@query(
    "q_decision_mix", sql("SELECT decision, count(*) AS transactions FROM dec GROUP BY 1", "dec")
)
def q_decision_mix(spark, sf_dir):
    return ops.decision_mix(_decisions(spark, sf_dir))


@query(
    "q_volume_by_minute",
    sql(
        """SELECT make_timestamp(us // 60000000 * 60000000) AS minute, decision,
            count(*) AS transactions FROM dec GROUP BY ALL""",
        "dec",
    ),
)
def q_volume_by_minute(spark, sf_dir):
    return ops.volume_by_minute(_decisions(spark, sf_dir))


@query(
    "q_investigation_queue",
    sql(
        """SELECT make_timestamp(us) AS event_time, transaction_id, customer_id, amount, currency,
            risk_score, rule_risk_score, round(fraud_probability, 9) AS fraud_probability, decision,
            replace(rules, ',', ', ') AS triggered_rules, detector_version
        FROM dec WHERE decision <> 'approve'""",
        "dec",
    ),
)
def q_investigation_queue(spark, sf_dir):
    return ops.investigation_queue(_decisions(spark, sf_dir)).withColumn(
        "fraud_probability", r9("fraud_probability")
    )


@query(
    "q_decision_lookup",
    sql(
        """SELECT decision, risk_score, rule_risk_score,
            round(fraud_probability, 9) AS fraud_probability, detector_version
        FROM dec WHERE transaction_id = '00000000-0000-4000-8000-000000000123'""",
        "dec",
    ),
)
def q_decision_lookup(spark, sf_dir):
    """One transaction from the decision table; the filter reaches one partition and its files."""
    root = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    rows = store.store_rows(decide(transactions(spark, sf_dir), keep=("seq",)))
    store.upsert(rows.withColumnRenamed("seq", "arrival"), root)
    wanted = "00000000-0000-4000-8000-000000000123"
    found = ops.decision_lookup(store.lookup_table(spark, root, wanted), wanted)
    return found.withColumns(
        {
            "risk_score": F.col("risk_score").cast("int"),
            "rule_risk_score": F.col("rule_risk_score").cast("int"),
            "fraud_probability": r9("fraud_probability"),
        }
    )


@query(
    "q_store_top_risk",
    sql(
        """SELECT transaction_id, CAST(risk_score AS INTEGER) AS risk_score, true AS stamped FROM log
        QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY processed_us DESC, seq DESC) = 1
            AND risk_score >= 90""",
        "log",
    ),
)
def q_store_top_risk(spark, sf_dir):
    """High risks from the table, stored in two batches of copies, with the stamp that storing them left."""
    root = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    began = spark.range(1).select(F.current_timestamp().alias("t")).first().t
    rows = stored(store.store_rows(_log(spark, sf_dir)))
    for part in (0, 1):
        store.upsert(rows.where(F.col("arrival") % 2 == part), root, is_stored=True)
    found = store.read_table(spark, root).where(F.col("risk_score") >= 90)
    return found.select(
        "transaction_id",
        F.col("risk_score").cast("int").alias("risk_score"),
        (F.col("ingested_at") >= F.lit(began)).alias("stamped"),
    )


# --- training and evaluation -------------------------------------------------------------------------


@query(
    "q_training_set",
    sql(
        """SELECT seq, make_timestamp(us) AS event_time, round(x0, 9) AS log_amount,
            x1 AS transaction_count_5m, x2 AS is_new_device, x3 AS is_new_country,
            x4 AS is_risky_merchant, label FROM lab""",
        "lab",
    ),
)
def q_training_set(spark, sf_dir):
    rows = training.training_set(_features(spark, sf_dir))
    return rows.withColumn("log_amount", r9("log_amount")).drop("amount")


def _split(spark, sf_dir):
    """Stored first: the cuts are looked up in the same rows that are split."""
    return training.with_split(stored(training.training_set(_features(spark, sf_dir))))


@query("q_ordered_split", sql("SELECT seq, split FROM cut", "cut"))
def q_ordered_split(spark, sf_dir):
    return _split(spark, sf_dir).select("seq", "split")


_SCALER_SQL = ", ".join(
    f"round(avg(x{i}), 9) AS {name}_mean, round(CASE WHEN stddev_pop(x{i}) = 0 THEN 1"
    f" ELSE stddev_pop(x{i}) END, 9) AS {name}_scale"
    for i, name in enumerate(config.FEATURE_NAMES)
)


@query("q_scaler", sql(f"SELECT {_SCALER_SQL} FROM cut WHERE split = 'train'", "cut"))
def q_scaler(spark, sf_dir):
    fitted = training.scaler(_split(spark, sf_dir).where("split = 'train'"))
    return fitted.select(*[r9(name).alias(name) for name in fitted.columns])


AUC_SQL = """SELECT (sum(CASE WHEN label THEN r END) - p * (p + 1) / 2.0::DOUBLE)
    / (p::DOUBLE * (n - p)) AS roc_auc
    FROM (SELECT label, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r,
        count(*) FILTER (WHERE label) OVER () AS p, count(*) OVER () AS n FROM lab)
    GROUP BY p, n"""
AP_SQL = """SELECT sum(pos / p * cum_pos / cum_all) AS average_precision
    FROM (SELECT *, sum(pos) OVER (ORDER BY s DESC)::DOUBLE AS cum_pos,
        sum(allr) OVER (ORDER BY s DESC)::DOUBLE AS cum_all, sum(pos) OVER ()::DOUBLE AS p
        FROM (SELECT s, count(*) FILTER (WHERE label) AS pos, count(*) AS allr FROM lab GROUP BY s))"""


@query("q_roc_auc", sql(f"SELECT round(roc_auc, 9) AS roc_auc FROM ({AUC_SQL})", "lab"))
def q_roc_auc(spark, sf_dir):
    return evaluation.ranking_quality(_scored(spark, sf_dir)).select(r9("roc_auc").alias("roc_auc"))


@query(
    "q_average_precision",
    sql(f"SELECT round(average_precision, 9) AS average_precision FROM ({AP_SQL})", "lab"),
)
def q_average_precision(spark, sf_dir):
    return evaluation.ranking_quality(_scored(spark, sf_dir)).select(
        r9("average_precision").alias("average_precision")
    )


CELLS_SQL = """count(*) FILTER (WHERE s < 0.5 AND NOT label) AS true_negative,
    count(*) FILTER (WHERE s >= 0.5 AND NOT label) AS false_positive,
    count(*) FILTER (WHERE s < 0.5 AND label) AS false_negative,
    count(*) FILTER (WHERE s >= 0.5 AND label) AS true_positive"""


@query("q_confusion", sql(f"SELECT {CELLS_SQL} FROM lab", "lab"))
def q_confusion(spark, sf_dir):
    return evaluation.threshold_quality(_scored(spark, sf_dir)).select(*evaluation.CELLS)


@query(
    "q_precision_recall",
    sql(
        f"""SELECT round(coalesce(true_positive::DOUBLE
                / nullif(true_positive + false_positive, 0), 0), 9) AS precision,
            round(coalesce(true_positive::DOUBLE
                / nullif(true_positive + false_negative, 0), 0), 9) AS recall
        FROM (SELECT {CELLS_SQL} FROM lab)""",
        "lab",
    ),
)
def q_precision_recall(spark, sf_dir):
    quality = evaluation.threshold_quality(_scored(spark, sf_dir))
    return quality.select(r9("precision").alias("precision"), r9("recall").alias("recall"))


@query(
    "q_brier",
    sql(
        """SELECT round(avg((s - CAST(label AS DOUBLE)) * (s - CAST(label AS DOUBLE))), 9)
            AS brier_score FROM lab""",
        "lab",
    ),
)
def q_brier(spark, sf_dir):
    return evaluation.threshold_quality(_scored(spark, sf_dir)).select(
        r9("brier_score").alias("brier_score")
    )


@query(
    "q_reliability",
    sql(
        """SELECT CAST(bin AS INTEGER) AS bin, count(*) AS transactions,
            round(avg(s), 9) AS mean_predicted, round(avg(CAST(label AS DOUBLE)), 9) AS observed_rate
        FROM (SELECT s, label, (s > q[1])::INT + (s > q[2])::INT + (s > q[3])::INT
                + (s > q[4])::INT AS bin
            FROM lab, (SELECT quantile_cont(s, [0.2, 0.4, 0.6, 0.8]) AS q FROM lab))
        GROUP BY bin""",
        "lab",
    ),
)
def q_reliability(spark, sf_dir):
    table = evaluation.reliability(_scored(spark, sf_dir))
    return table.withColumns(
        {"mean_predicted": r9("mean_predicted"), "observed_rate": r9("observed_rate")}
    )


@query(
    "q_holdout_report",
    sql(
        f"""SELECT holdout_samples, positives, round(roc_auc, 9) AS roc_auc,
            round(average_precision, 9) AS average_precision, round(precision, 9) AS precision,
            round(recall, 9) AS recall, round(brier_score, 9) AS brier_score
        FROM (SELECT count(*) AS holdout_samples, count(*) FILTER (WHERE label) AS positives,
                coalesce(count(*) FILTER (WHERE s >= 0.5 AND label)::DOUBLE
                    / nullif(count(*) FILTER (WHERE s >= 0.5), 0), 0) AS precision,
                coalesce(count(*) FILTER (WHERE s >= 0.5 AND label)::DOUBLE
                    / nullif(count(*) FILTER (WHERE label), 0), 0) AS recall,
                avg((s - CAST(label AS DOUBLE)) * (s - CAST(label AS DOUBLE))) AS brier_score
            FROM cut WHERE split = 'test'),
            ({AUC_SQL.replace("FROM lab", "FROM cut WHERE split = 'test'")}),
            ({AP_SQL.replace("FROM lab", "FROM cut WHERE split = 'test'")})""",
        "cut",
    ),
)
def q_holdout_report(spark, sf_dir):
    """The published model on the last fifth of the labelled rows."""
    artifact = config.published_artifact()
    test = scoring.with_probability(_split(spark, sf_dir).where("split = 'test'"), artifact)
    report = evaluation.holdout_report(test, artifact.decision_threshold)
    counts = ("holdout_samples", "positives")
    return report.select(*[c if c in counts else r9(c).alias(c) for c in report.columns])


def _candidate(spark, sf_dir):
    """Artifact rows with everything that can be measured on the tables measured anew."""
    rows = _split(spark, sf_dir)
    artifact = config.published_artifact()
    fitted = training.scaler(rows.where("split = 'train'"))
    test = scoring.with_probability(rows.where("split = 'test'"), artifact)
    quality = evaluation.threshold_quality(test, artifact.decision_threshold)
    size = rows.agg(F.count("*").alias("n"))
    ranking = evaluation.ranking_quality(test)

    def entry(field, position, kind, column):
        value = F.col(column).cast("double")
        text = F.col(column).cast("string") if kind == "exact" else F.lit(None).cast("string")
        number = value if kind != "exact" else F.lit(None).cast("double")
        return F.struct(
            F.lit(field).alias("field"), F.lit(position).alias("position"),
            F.lit(kind).alias("kind"), text.alias("text"), number.alias("number"),
        )

    def long(df, entries):
        return df.select(F.inline(F.array(*entries)))

    names = config.FEATURE_NAMES
    vectors = [
        entry(f"scaler_{part}", i, "parameter", f"{name}_{part}")
        for part in ("mean", "scale")
        for i, name in enumerate(names)
    ]
    metrics = [
        entry("training.metrics.precision_at_0_5", 0, "metric", "precision"),
        entry("training.metrics.recall_at_0_5", 0, "metric", "recall"),
        *[
            entry(f"training.metrics.confusion_matrix.{cell}", 0, "count", cell)
            for cell in evaluation.CELLS
        ],
    ]
    ranks = [
        entry(f"training.metrics.{name}", 0, "metric", name)
        for name in ("roc_auc", "average_precision")
    ]
    measured = (
        long(fitted, vectors)
        .unionAll(long(quality, metrics))
        .unionAll(long(ranking, ranks))
        .unionAll(long(size, [entry("training.samples", 0, "exact", "n")]))
    )
    committed = spark.createDataFrame(evaluation.artifact_rows(MODEL), evaluation.ARTIFACT_ROWS)
    kept = committed.join(measured.select("field").distinct(), "field", "left_anti")
    return committed, kept.select(*committed.columns).unionAll(measured)


def _diff_sql() -> str:
    def beyond(field, value, committed, limit):
        return f"CASE WHEN abs({value} - {committed}::DOUBLE) > {limit} THEN '{field} differs beyond tolerance' END"

    def vector(field, function):
        tests = []
        for i, committed in enumerate(MODEL[field]):
            value = f"{function}(x{i}) FILTER (WHERE split = 'train')"
            tests.append(
                f"abs({value} - {committed}::DOUBLE) > greatest(1e-5 * greatest(abs({value}),"
                f" {abs(committed)}::DOUBLE), 1e-7)"
            )
        return f"CASE WHEN {' OR '.join(tests)} THEN '{field} differs beyond tolerance' END"

    metrics = MODEL["training"]["metrics"]
    cells = metrics["confusion_matrix"]
    conditions = {
        "true_negative": "s < 0.5 AND NOT label",
        "false_positive": "s >= 0.5 AND NOT label",
        "false_negative": "s < 0.5 AND label",
        "true_positive": "s >= 0.5 AND label",
    }
    count = {
        cell: f"count(*) FILTER (WHERE split = 'test' AND {condition})"
        for cell, condition in conditions.items()
    }
    tp = count["true_positive"]
    checks = [
        vector("scaler_mean", "avg"),
        vector("scaler_scale", "stddev_pop"),
        "CASE WHEN count(*) <> 20000 THEN 'training.samples differs' END",
        beyond(
            "training.metrics.precision_at_0_5",
            f"({tp})::DOUBLE / ({tp} + {count['false_positive']})",
            metrics["precision_at_0_5"],
            5e-3,
        ),
        beyond(
            "training.metrics.recall_at_0_5",
            f"({tp})::DOUBLE / ({tp} + {count['false_negative']})",
            metrics["recall_at_0_5"],
            5e-3,
        ),
        *[
            beyond(f"training.metrics.confusion_matrix.{cell}", count[cell], cells[cell], 10)
            for cell in cells
        ],
    ]
    test_auc = AUC_SQL.replace("FROM lab", "FROM cut WHERE split = 'test'")
    test_ap = AP_SQL.replace("FROM lab", "FROM cut WHERE split = 'test'")
    ranks = [
        beyond("training.metrics.roc_auc", f"({test_auc})", metrics["roc_auc"], 5e-3),
        beyond(
            "training.metrics.average_precision", f"({test_ap})", metrics["average_precision"], 5e-3
        ),
    ]
    return sql(
        f"""SELECT difference FROM (
            SELECT unnest([{', '.join(checks)}]) AS difference FROM cut
            UNION ALL SELECT unnest([{', '.join(ranks)}]))
        WHERE difference IS NOT NULL""",
        "cut",
    )


@query("q_artifact_diff", _diff_sql())
def q_artifact_diff(spark, sf_dir):
    committed, candidate = _candidate(spark, sf_dir)
    return evaluation.artifact_differences(committed, candidate)


def _training_sql() -> str:
    """The whole fit in SQL: scaler, balanced fit, calibration, and how it does on the test rows."""
    names = range(len(config.FEATURE_NAMES))
    scaled = ", ".join(f"(x{i} - m{i}) / s{i} AS z{i}" for i in names)
    scales = ", ".join(
        f"avg(x{i}) AS m{i}, CASE WHEN stddev_pop(x{i}) = 0 THEN 1 ELSE stddev_pop(x{i}) END AS s{i}" for i in names
    )
    last = len(config.FEATURE_NAMES)
    logit = " + ".join([*(f"w{i} * z{i}" for i in names), f"w{last}"])
    final = "(SELECT * FROM {0} ORDER BY step DESC LIMIT 1)"
    numbers = [
        *(f"SELECT 'scaler_mean', {i}, m{i} FROM scales" for i in names),
        *(f"SELECT 'scaler_scale', {i}, s{i} FROM scales" for i in names),
        *(f"SELECT 'coefficients', {i}, w{i} FROM weights" for i in names),
        f"SELECT 'intercept', 0, w{last} FROM weights",
        "SELECT 'calibration.a', 0, a FROM platt",
        "SELECT 'calibration.b', 0, b FROM platt",
        f"SELECT 'training.metrics.roc_auc', 0, round(roc_auc, 4) FROM ({AUC_SQL.replace('FROM lab', 'FROM tested')})",
        "SELECT 'training.metrics.average_precision', 0, round(average_precision, 4) FROM "
        f"({AP_SQL.replace('FROM lab', 'FROM tested')})",
        *(f"SELECT 'training.metrics.confusion_matrix.{c}', 0, {c} FROM cells" for c in evaluation.CELLS),
        """SELECT 'training.metrics.precision_at_0_5', 0, round(coalesce(true_positive::DOUBLE
            / nullif(true_positive + false_positive, 0), 0), 4) FROM cells""",
        """SELECT 'training.metrics.recall_at_0_5', 0, round(coalesce(true_positive::DOUBLE
            / nullif(true_positive + false_negative, 0), 0), 4) FROM cells""",
    ]
    tables = f"""
        parts AS MATERIALIZED (SELECT * FROM cut),
        scales AS MATERIALIZED (SELECT {scales} FROM parts WHERE split = 'train'),
        scaled AS MATERIALIZED (SELECT split, label, label::INT::DOUBLE AS y, {scaled} FROM parts, scales),
        counts AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE label) AS p FROM parts WHERE split = 'train'),
        balanced AS MATERIALIZED (SELECT s.*, CASE WHEN label THEN n / (2 * p) ELSE n / (2 * (n - p)) END AS wt
            FROM scaled s, counts WHERE split = 'train'),
        steps AS (WITH RECURSIVE fit AS ({newton_sql("balanced", [f"z{i}" for i in names])}) SELECT * FROM fit),
        weights AS MATERIALIZED {final.format("steps")},
        raw_scores AS MATERIALIZED (SELECT split, label, y, 1::DOUBLE AS wt, {logit} AS l FROM scaled, weights),
        held AS MATERIALIZED (SELECT * FROM raw_scores WHERE split = 'calibration'),
        platt_steps AS (WITH RECURSIVE fit AS ({newton_sql("held", ["l"])}) SELECT * FROM fit),
        platt AS MATERIALIZED (SELECT w0 AS a, w1 AS b FROM {final.format("platt_steps")}),
        tested AS MATERIALIZED (SELECT label, 1 / (1 + exp(-(a * l + b))) AS s FROM raw_scores, platt
            WHERE split = 'test'),
        cells AS (SELECT {CELLS_SQL} FROM tested)"""
    statement = " UNION ALL ".join(numbers)
    return sql(
        f"""SELECT field, CAST(position AS INTEGER) AS position, round(number::DOUBLE, 6) AS number
        FROM ({statement}) AS t(field, position, number)""",
        "cut",
    ).replace("\nSELECT field, CAST(position", f",{tables}\nSELECT field, CAST(position", 1)


@query("q_train_model", _training_sql())
def q_train_model(spark, sf_dir):
    """The numbers of an artifact fitted on the tables, from the scaler to the metrics of the test rows."""
    document = training.train(_features(spark, sf_dir))
    fitted = [
        (field, position, number)
        for field, position, _, _, number in evaluation.artifact_rows(document)
        if number is not None
    ]
    numbers = spark.createDataFrame(fitted, "field string, position int, number double")
    return numbers.withColumn("number", F.round("number", 6))


def _of_messages(statement: str) -> str:
    """The same SQL over what is left when broken messages have been rejected."""
    return statement.replace("WHERE errors = '')", "WHERE errors = '' AND k NOT IN (33, 36))")


def _refusals() -> dict[str, dict]:
    """Documents that break the contract of an artifact in one place each."""
    good = config.PUBLISHED_ARTIFACT
    names, scale = good["feature_names"], good["scaler_scale"]
    return {
        "another version": good | {"artifact_version": good["artifact_version"] + 1},
        "another feature order": good | {"feature_names": list(reversed(names))},
        "a weight missing": good | {"coefficients": good["coefficients"][:-1]},
        "a scale of zero": good | {"scaler_scale": [0.0, *scale[1:]]},
        "no intercept": {k: v for k, v in good.items() if k != "intercept"},
    }


@query(
    "q_artifact_roundtrip",
    sql(
        f"""SELECT 'decided as ' || decision AS outcome, count(*) AS cases FROM dec GROUP BY ALL
        UNION ALL SELECT unnest([{", ".join(f"'refused: {case}'" for case in _refusals())}]), 1""",
        "dec",
    ),
)
def q_artifact_roundtrip(spark, sf_dir):
    """All transactions decided with an artifact written to shared storage and read back; broken ones are refused."""
    root = f"{checkpoint_dir(spark)}/artifacts-{uuid.uuid4().hex}"
    artifacts.save_artifact(spark, config.PUBLISHED_ARTIFACT, f"{root}/model.json")
    loaded = artifacts.load_artifact(spark, f"{root}/model.json")
    refused = []
    for number, (case, document) in enumerate(_refusals().items()):
        text = spark.createDataFrame([(json.dumps(document),)], "value string")
        text.coalesce(1).write.text(f"{root}/{number}")
        try:
            artifacts.load_artifact(spark, f"{root}/{number}")
        except ValueError:
            refused.append((f"refused: {case}", 1))
    decided = decide(transactions(spark, sf_dir), artifact=loaded).groupBy("decision").agg(F.count("*").alias("cases"))
    return decided.select(F.concat(F.lit("decided as "), "decision").alias("outcome"), "cases").unionByName(
        spark.createDataFrame(refused, "outcome string, cases long")
    )


# --- monitoring ----------------------------------------------------------------------------------------


@query(
    "q_outcome_counters",
    sql(
        """SELECT 'api_transactions' AS counter,
            CASE WHEN errors = '' THEN 'accepted' ELSE 'rejected' END AS label, count(*) AS value
        FROM checked GROUP BY ALL
        UNION ALL SELECT 'detector_failures', 'validation', count(*) FROM checked WHERE errors <> ''
        UNION ALL SELECT 'detector_transactions', decision, count(*) FROM dec GROUP BY ALL
        UNION ALL SELECT 'store_decisions', decision, count(*) FROM dec GROUP BY ALL
        UNION ALL SELECT 'alerts_received', decision, count(*) FROM dec
            WHERE decision <> 'approve' GROUP BY ALL
        UNION ALL SELECT 'alerts_dispatched', 'log', count(*) FROM dec
            WHERE decision <> 'approve'""",
        "dec",
    ),
)
def q_outcome_counters(spark, sf_dir):
    """Every counter from its own rows: checked messages, decisions, stored rows, routed alerts, logged lines."""
    checked = stored(_checked(spark, sf_dir).select("seq", "errors"))
    scored = stored(_decisions(spark, sf_dir))
    kept = store.enforce(store.store_rows(scored))
    alerted = ops.alerts(scored)
    return monitoring.outcome_counters(checked, scored, kept, alerted, alerted.select(alert_line().alias("line")))


@query(
    "q_stream_counters",
    _of_messages(
        sql(
            f"""SELECT 'detector_transactions' AS counter, decision AS label, count(*) AS value FROM dec GROUP BY ALL
            UNION ALL SELECT 'alerts_received', decision, count(*) FROM dec WHERE decision <> 'approve' GROUP BY ALL
            UNION ALL SELECT 'detector_failures', 'validation', count(*)
                FROM ({DECODED_SQL}) WHERE errors <> ''""",
            "dec",
        )
    ),
)
def q_stream_counters(spark, sf_dir):
    """Counters kept by a stream over the topics that the one job for all sinks has written."""
    topics, checkpoints = _published(spark, sf_dir)
    _finish(start_pipeline(spark, topics, f"{topics.root}/table", checkpoints))
    _finish(start_counters(spark, topics, f"{topics.root}/counters", checkpoints))
    return read_counters(spark, f"{topics.root}/counters")


def _bound_text():
    le = F.col("le")
    return F.when(le == monitoring.INFINITE, "+Inf").otherwise(le.cast("string"))


_BOUNDS = " UNION ALL ".join(
    f"SELECT '{bound}' AS le, count(*) FILTER (WHERE fraud_probability <= {bound}) AS bucket_count"
    " FROM dec"
    for bound in config.PROBABILITY_BUCKETS
)


@query(
    "q_probability_histogram", sql(f"{_BOUNDS} UNION ALL SELECT '+Inf', count(*) FROM dec", "dec")
)
def q_probability_histogram(spark, sf_dir):
    return monitoring.probability_histogram(_decisions(spark, sf_dir)).withColumn(
        "le", _bound_text()
    )


@query(
    "q_duration_summary",
    sql(
        """SELECT route, count(*) AS events, round(sum(seconds), 6) AS total_seconds,
            round(avg(seconds), 9) AS mean_seconds FROM req GROUP BY route""",
        "req",
    ),
)
def q_duration_summary(spark, sf_dir):
    summary = monitoring.duration_summary(derived.request_log(spark, sf_dir), ("route",))
    return summary.withColumns(
        {"total_seconds": F.round("total_seconds", 6), "mean_seconds": r9("mean_seconds")}
    )


_DURATION_BOUNDS = " UNION ALL ".join(
    f"SELECT route, '{bound}' AS le, count(*) FILTER (WHERE seconds <= {bound}::DOUBLE)"
    " AS bucket_count FROM req GROUP BY route"
    for bound in monitoring.DURATION_BUCKETS
)


@query(
    "q_duration_histogram",
    sql(
        f"{_DURATION_BOUNDS} UNION ALL SELECT route, '+Inf', count(*) FROM req GROUP BY route", "req"
    ),
)
def q_duration_histogram(spark, sf_dir):
    requests = derived.request_log(spark, sf_dir)
    return monitoring.histogram(
        requests, "seconds", monitoring.DURATION_BUCKETS, ("route",)
    ).withColumn("le", _bound_text())


@query(
    "q_consumer_lag",
    sql(
        """SELECT seq, 'fraud-detector-v1' AS "group", 'transactions.raw' AS topic,
            CAST(part AS INTEGER) AS "partition", lag FROM offs""",
        "offs",
    ),
)
def q_consumer_lag(spark, sf_dir):
    samples = derived.offset_samples(spark, sf_dir)
    return samples.select(
        "seq",
        "group",
        "topic",
        "partition",
        monitoring.lag(F.col("high"), F.col("committed")).alias("lag"),
    )


LAG_TICKS = """SELECT tick, sum(lag) AS lag FROM (
    SELECT t AS tick, part, arg_max(lag, m) AS lag FROM (
        SELECT part, m, lag, unnest(range(m, m + 5)) AS t FROM (
            SELECT part, (us + 59999999) // 60000000 AS m, arg_max(lag, us) AS lag
            FROM offs GROUP BY ALL))
    GROUP BY ALL) GROUP BY tick"""
# Consecutive whole steps share tick - row_number.
ISLANDS = """SELECT *, min(tick) OVER (PARTITION BY {keys} island) AS since FROM (
    SELECT *, tick - row_number() OVER (PARTITION BY {by} ORDER BY tick) AS island
    FROM ({ticks}))"""


@query(
    "q_lag_alerts",
    sql(
        f"""SELECT 'fraud-detector-v1' AS "group", make_timestamp(tick * 60000000) AS sampled_at,
            make_timestamp(since * 60000000) AS active_since
        FROM ({ISLANDS.format(keys='', by='1', ticks=f'SELECT * FROM ({LAG_TICKS}) WHERE lag > 1000')})
        WHERE tick - since >= 5""",
        "offs",
    ),
)
def q_lag_alerts(spark, sf_dir):
    samples = derived.offset_samples(spark, sf_dir)
    lags = samples.withColumn("lag", monitoring.lag(F.col("high"), F.col("committed")))
    return monitoring.lag_alerts(lags)


INCREASES = """SELECT t.metric, t.taken,
        CASE WHEN t.taken - t.prior < {w} THEN sum(s.grown) END AS grown
    FROM steps t LEFT JOIN steps s
        ON s.metric = t.metric AND s.taken <= t.taken AND s.prior > t.taken - {w}
    GROUP BY t.metric, t.taken, t.prior"""


@query(
    "q_failure_alerts",
    sql(
        f"""SELECT metric, 'validation' AS label, make_timestamp(taken) AS sampled_at,
            CAST(grown AS DOUBLE) AS increase
        FROM ({INCREASES.format(w=300000000)}) WHERE metric = 'detector_failures' AND grown > 0""",
        "steps",
    ),
)
def q_failure_alerts(spark, sf_dir):
    samples = derived.metric_samples(spark, sf_dir)
    failures = samples.where(F.col("metric") == "detector_failures")
    return monitoring.failure_alerts(failures, ["metric", "label"])


@query(
    "q_sink_failure_alerts",
    sql(
        f"""SELECT metric, CASE metric WHEN 'store_failures' THEN 'validation' ELSE 'webhook' END AS label,
            make_timestamp(taken) AS sampled_at, CAST(grown AS DOUBLE) AS increase
        FROM ({INCREASES.format(w=300000000).replace('steps', 'fsteps')}) WHERE grown > 0""",
        "fsteps",
    ),
)
def q_sink_failure_alerts(spark, sf_dir):
    """The rules for the store and the webhook."""
    return monitoring.failure_alerts(derived.failure_samples(spark, sf_dir), ["metric", "label"])


_STALLED = f"""SELECT a.taken // 60000000 AS tick
    FROM ({INCREASES.format(w=600000000)}) s JOIN ({INCREASES.format(w=600000000)}) a
        ON s.taken = a.taken AND s.metric = 'detector_transactions' AND a.metric = 'api_transactions'
    WHERE s.grown = 0 AND a.grown > 0"""


@query(
    "q_stall_alerts",
    sql(
        f"""SELECT make_timestamp(tick * 60000000) AS sampled_at,
            make_timestamp(since * 60000000) AS active_since
        FROM ({ISLANDS.format(keys='', by='1', ticks=_STALLED)}) WHERE tick - since >= 5""",
        "steps",
    ),
)
def q_stall_alerts(spark, sf_dir):
    samples = derived.metric_samples(spark, sf_dir)
    scored = samples.where(F.col("metric") == "detector_transactions")
    accepted = samples.where(F.col("metric") == "api_transactions")
    # Hole of 15 minutes: the alert needs the same samples at whole minutes on both sides.
    return monitoring.stall_alerts(scored, accepted, ["metric", "label"])


_SLOW = """SELECT route, started // 60000000 AS tick FROM req
    GROUP BY ALL HAVING avg(seconds) > 0.05"""


@query(
    "q_sustained",
    sql(
        f"""SELECT route, make_timestamp(tick * 60000000) AS sampled_at,
            make_timestamp(since * 60000000) AS active_since
        FROM ({ISLANDS.format(keys='route,', by='route', ticks=_SLOW)}) WHERE tick - since >= 1""",
        "req",
    ),
)
def q_sustained(spark, sf_dir):
    """A route counts as down in a minute whose mean duration is above 50 ms."""
    up = (
        derived.request_log(spark, sf_dir)
        .groupBy("route", F.date_trunc("minute", "started_at").alias("sampled_at"))
        .agg((F.avg("seconds") <= 0.05).cast("int").alias("value"))
    )
    return monitoring.down_alerts(up, ["route"])


_LE = ", ".join(
    f"struct_pack(le := {bound}::DOUBLE, c := count(*) FILTER (WHERE seconds <= {bound}::DOUBLE))"
    for bound in (*monitoring.DURATION_BUCKETS, "'inf'")
)


@query(
    "q_bucket_quantile",
    sql(
        f"""SELECT route, make_timestamp(w * 300000000) AS window_start,
            round(CASE WHEN le = 'inf'::DOUBLE THEN lower
                ELSE lower + (le - lower) * coalesce((0.95::DOUBLE * n - below)
                    / nullif(c - below, 0), 0) END, 9) AS quantile_value
        FROM (SELECT *, lag(le, 1, 0.0::DOUBLE) OVER b AS lower, lag(c, 1, 0) OVER b AS below,
                max(c) OVER (PARTITION BY route, w) AS n
            FROM (SELECT route, w, bucket.le AS le, bucket.c AS c FROM (
                SELECT route, w, unnest(buckets) AS bucket FROM (
                    SELECT route, started // 300000000 AS w, [{_LE}] AS buckets
                    FROM req GROUP BY route, w)))
            WINDOW b AS (PARTITION BY route, w ORDER BY le))
        WHERE c >= 0.95::DOUBLE * n
        QUALIFY row_number() OVER (PARTITION BY route, w ORDER BY le) = 1""",
        "req",
    ),
)
def q_bucket_quantile(spark, sf_dir):
    requests = derived.request_log(spark, sf_dir).withColumn(
        "window_start", F.window("started_at", "5 minutes")["start"]
    )
    keys = ("route", "window_start")
    buckets = monitoring.histogram(requests, "seconds", monitoring.DURATION_BUCKETS, keys)
    return monitoring.bucket_quantile(buckets, 0.95, keys).withColumn(
        "quantile_value", r9("quantile_value")
    )


_BUCKET_STEPS = f"""SELECT metric, taken, lag(taken) OVER w AS prior,
        CASE WHEN v >= lag(v) OVER w THEN v - lag(v) OVER w WHEN lag(v) OVER w IS NOT NULL THEN v END AS grown
    FROM (SELECT route || '|' || CAST(le AS VARCHAR) AS metric, (m + 1) * 60000000 AS taken,
            sum(c) OVER (PARTITION BY route, le, m - {EPOCH} // 60000000 >= 120 ORDER BY m) AS v
        FROM (SELECT route, m, bucket.le AS le, bucket.c AS c FROM (
            SELECT route, m, unnest(buckets) AS bucket FROM (
                SELECT route, started // 60000000 AS m, [{_LE}] AS buckets FROM req GROUP BY route, m))))
    WINDOW w AS (PARTITION BY metric ORDER BY taken)"""


@query(
    "q_bucket_rate_quantile",
    sql(
        f"""SELECT route, make_timestamp(taken) AS sampled_at,
            round(CASE WHEN le = 'inf'::DOUBLE THEN lower
                ELSE lower + (le - lower) * coalesce((0.95::DOUBLE * n - below)
                    / nullif(c - below, 0), 0) END, 9) AS quantile_value
        FROM (SELECT *, lag(le, 1, 0.0::DOUBLE) OVER b AS lower, lag(c, 1, 0) OVER b AS below,
                max(c) OVER (PARTITION BY route, taken) AS n
            FROM (SELECT split_part(metric, '|', 1) AS route, CAST(split_part(metric, '|', 2) AS DOUBLE) AS le,
                    taken, CAST(grown AS DOUBLE) AS c
                FROM (WITH steps AS ({_BUCKET_STEPS}) {INCREASES.format(w=300000000)})
                WHERE grown IS NOT NULL)
            WINDOW b AS (PARTITION BY route, taken ORDER BY le))
        WHERE c >= 0.95::DOUBLE * n
        QUALIFY row_number() OVER (PARTITION BY route, taken ORDER BY le) = 1""",
        "req",
    ),
)
def q_bucket_rate_quantile(spark, sf_dir):
    """The 95th percentile from the five-minute growth of each route's bucket counters."""
    samples = derived.bucket_samples(spark, sf_dir)
    return monitoring.bucket_rate_quantile(samples, 0.95, ["route"]).withColumn(
        "quantile_value", r9("quantile_value")
    )


_PLACES = ", ".join(
    f"max(seconds) FILTER (WHERE i = least(n - 1, CAST(floor(n * {f}::DOUBLE) AS BIGINT)))"
    f" AS p{round(f * 100)}"
    for f in monitoring.PERCENTILES
)


@query(
    "q_latency_percentiles",
    sql(
        f"""SELECT route, {_PLACES} FROM (SELECT route, seconds,
            row_number() OVER (PARTITION BY route ORDER BY seconds) - 1 AS i,
            count(*) OVER (PARTITION BY route) AS n FROM req) GROUP BY route""",
        "req",
    ),
)
def q_latency_percentiles(spark, sf_dir):
    return monitoring.latency_percentiles(derived.request_log(spark, sf_dir), ["route"])


@query(
    "q_throughput",
    sql(
        """SELECT count(*) AS requests,
            round((max(finished) - min(started)) / 1000000, 6) AS elapsed_seconds,
            round(count(*) / ((max(finished) - min(started)) / 1000000), 9) AS per_second
        FROM req""",
        "req",
    ),
)
def q_throughput(spark, sf_dir):
    return monitoring.throughput(derived.request_log(spark, sf_dir)).withColumns(
        {"elapsed_seconds": F.round("elapsed_seconds", 6), "per_second": r9("per_second")}
    )


@query(
    "q_pipeline_throughput",
    sql(
        """SELECT accepted, stored, round(accepted / ((last_in - first_in) / 1000000), 9) AS ingest_per_second,
            round(stored / ((last_out - first_in) / 1000000), 9) AS end_to_end_per_second
        FROM (SELECT count(*) AS accepted, min(us) AS first_in, max(us) AS last_in FROM ok),
            (SELECT count(DISTINCT transaction_id) AS stored, max(processed_us) AS last_out FROM (
                SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY transaction_id
                    ORDER BY processed_us DESC, seq DESC) = 1))""",
        "log",
    ),
)
def q_pipeline_throughput(spark, sf_dir):
    accepted = _valid(spark, sf_dir).select(F.col("event_time").alias("accepted_at"))
    copies = stored(_log(spark, sf_dir).select("transaction_id", "processed_at", "arrival"))
    kept = store.latest_decisions(copies)
    rates = monitoring.pipeline_throughput(accepted, kept)
    return rates.withColumns({c: r9(c) for c in ("ingest_per_second", "end_to_end_per_second")})


# --- messages end to end, streaming jobs ------------------------------------------------------------------------------------


def _published(spark, sf_dir) -> tuple[Topics, str]:
    """A fresh set of file topics whose raw topic holds all messages of the tables."""
    root = f"{checkpoint_dir(spark)}/topics-{uuid.uuid4().hex}"
    topics = Topics(root=root)
    topics.append(derived.raw_messages(spark, sf_dir), config.TOPIC_RAW, ordered=True)
    return topics, f"{root}/checkpoints"


def _finish(*queries) -> None:
    for streaming in queries:
        streaming.awaitTermination()


@query("q_message_decisions", _of_messages(sql(DECISIONS_SQL, "dec")))
def q_message_decisions(spark, sf_dir):
    """The batch counterpart of the stream: JSON messages in arrival order."""
    return _flat(decide_messages(derived.raw_messages(spark, sf_dir)))


@query("q_stream_decisions", _of_messages(sql(DECISIONS_SQL, "dec")))
def q_stream_decisions(spark, sf_dir):
    """Raw topic through the stateful scoring stream, read back from the scored topic."""
    topics, checkpoints = _published(spark, sf_dir)
    _finish(jobs.start_scoring(spark, topics, checkpoints))
    scored = topics.table(spark, config.TOPIC_SCORED)
    return _flat(contract.valid(contract.decode_decisions(scored)))


@query(
    "q_stream_pipeline",
    _of_messages(
        sql(
            f"""SELECT 'table' AS sink, decision AS label, count(*) AS messages FROM dec GROUP BY ALL
            UNION ALL SELECT 'scored', decision, count(*) FROM dec GROUP BY ALL
            UNION ALL SELECT 'alerts', decision, count(*) FROM dec WHERE decision <> 'approve' GROUP BY ALL
            UNION ALL SELECT 'dead letters', replace(errors, ';', '; '), count(*)
                FROM ({DECODED_SQL}) WHERE errors <> '' GROUP BY ALL""",
            "dec",
        )
    ),
)
def q_stream_pipeline(spark, sf_dir):
    """Raw topic through the one job that feeds all sinks; what each of them holds."""
    topics, checkpoints = _published(spark, sf_dir)
    table = f"{topics.root}/table"
    _finish(start_pipeline(spark, topics, table, checkpoints))
    label = F.get_json_object(F.col("value").cast("string"), "$.decision").alias("label")
    held = store.read_table(spark, table).select(F.lit("table").alias("sink"), F.col("decision").alias("label"))
    for sink, topic in (("scored", config.TOPIC_SCORED), ("alerts", config.TOPIC_ALERTS)):
        held = held.unionByName(topics.table(spark, topic).select(F.lit(sink).alias("sink"), label))
    letters = topics.table(spark, config.TOPIC_DEAD_LETTER)
    held = held.unionByName(
        letters.select(F.lit("dead letters").alias("sink"), dead_letter.header("error").alias("label"))
    )
    return held.groupBy("sink", "label").agg(F.count("*").alias("messages"))


@query(
    "q_stream_durations",
    sql(
        """SELECT count(*) AS events, true AS each_batch_once, true AS all_timed FROM txn""",
        "txn",
    ),
)
def q_stream_durations(spark, sf_dir):
    """What a listener recorded while the scoring stream ran: the events of its batches add up to all messages."""
    topics, checkpoints = _published(spark, sf_dir)
    listener = record_progress(spark, f"{topics.root}/progress")
    scoring_query = jobs.start_scoring(spark, topics, checkpoints)
    _finish(scoring_query)
    listener.wait_for(scoring_query)
    spark.streams.removeListener(listener)
    batches = batch_durations(spark, f"{topics.root}/progress")
    return batches.where(F.col("run") == str(scoring_query.runId)).agg(
        F.sum("events").alias("events"),
        (F.count("*") == F.count_distinct("batch")).alias("each_batch_once"),
        F.min(F.col("seconds") > 0).alias("all_timed"),
    )


@query(
    "q_stream_dead_letters",
    sql(
        f"""SELECT 'detector' AS source, replace(errors, ';', '; ') AS error, count(*) AS messages
        FROM ({DECODED_SQL}) WHERE errors <> '' GROUP BY ALL""",
        "checked",
    ),
)
def q_stream_dead_letters(spark, sf_dir):
    topics, checkpoints = _published(spark, sf_dir)
    _finish(jobs.start_rejects(spark, topics, checkpoints))
    return dead_letter.profile(topics.table(spark, config.TOPIC_DEAD_LETTER))


@query(
    "q_replay_again",
    sql(
        f"""SELECT c.customer_id AS "key", count(*) AS messages
        FROM checked c JOIN ({DECODED_SQL}) d ON c.seq = d."offset" WHERE d.errors <> ''
        GROUP BY 1""",
        "checked",
    ),
)
def q_replay_again(spark, sf_dir):
    """Rejected, replayed, rejected and replayed: the second replay has all messages again."""
    topics, checkpoints = _published(spark, sf_dir)
    for _ in range(2):
        _finish(jobs.start_rejects(spark, topics, checkpoints))
        last = jobs.replay(spark, topics, f"{topics.root}/ledger")
    return last.groupBy(F.col("key").cast("string").alias("key")).agg(
        F.count("*").alias("messages")
    )


@query(
    "q_stream_store",
    _of_messages(
        sql(
            """SELECT transaction_id, customer_id, CAST(amount AS DECIMAL(14, 2)) AS amount,
                decision, CAST(risk_score AS SMALLINT) AS risk_score, rules AS triggered_rules
            FROM dec""",
            "dec",
        )
    ),
)
def q_stream_store(spark, sf_dir):
    """Raw topic, scored topic, decision table; the second run stores all of it again."""
    topics, checkpoints = _published(spark, sf_dir)
    table = f"{topics.root}/table"
    _finish(jobs.start_scoring(spark, topics, checkpoints))
    _finish(*jobs.start_store(spark, topics, table, checkpoints))
    _finish(*jobs.start_store(spark, topics, table, f"{checkpoints}/again"))
    return store.read_table(spark, table).select(
        "transaction_id",
        "customer_id",
        "amount",
        "decision",
        "risk_score",
        F.array_join("triggered_rules", ",").alias("triggered_rules"),
    )


@query(
    "q_stream_alerts",
    _of_messages(
        sql(
            """SELECT 'FRAUD_ALERT transaction_id=' || transaction_id || ' customer_id='
                || customer_id || ' decision=' || decision || ' risk_score=' || risk_score
                || ' amount=' || amount || ' ' || currency || ' rules=' || rules AS line
            FROM dec WHERE decision <> 'approve'""",
            "dec",
        )
    ),
)
def q_stream_alerts(spark, sf_dir):
    """Raw, scored and alert topic, down to the lines of the alert log."""
    topics, checkpoints = _published(spark, sf_dir)
    _finish(jobs.start_scoring(spark, topics, checkpoints))
    _finish(jobs.start_alert_routing(spark, topics, checkpoints))
    _finish(*jobs.start_alert_log(spark, topics, f"{topics.root}/lines", checkpoints))
    return spark.read.text(f"{topics.root}/lines").withColumnRenamed("value", "line")


def _refuse_declined(payload: str) -> None:
    if '"decision":"decline"' in payload:
        raise ConnectionError("refused")


@query(
    "q_alert_delivery",
    sql(
        """SELECT transaction_id, CASE WHEN decision = 'decline' THEN 3 ELSE 1 END AS attempts,
            decision <> 'decline' AS delivered FROM dec WHERE decision <> 'approve'""",
        "dec",
    ),
)
def q_alert_delivery(spark, sf_dir):
    """Three attempts per alert against a receiver that refuses declined payments."""
    flagged = ops.alerts(_decisions(spark, sf_dir))
    messages = contract.to_message(
        flagged, "customer_id", scoring.DECISION_COLUMNS, keep=("transaction_id",)
    )
    quick = config.Settings(alert_backoff_seconds=0.0)
    return deliver_alerts(messages, _refuse_declined, quick).select(
        "transaction_id", "attempts", "delivered"
    )


@query(
    "q_sink_counters",
    sql(
        """SELECT counter, label, count(*) AS value FROM (
            SELECT unnest(CASE WHEN NOT fine THEN [{'counter': 'store_failures', 'label': 'validation'},
                    CASE WHEN decision <> 'approve' THEN {'counter': 'alert_failures', 'label': 'validation'} END]
                WHEN decision = 'approve' THEN [{'counter': 'store_decisions', 'label': decision}]
                ELSE [{'counter': 'store_decisions', 'label': decision},
                    {'counter': 'alerts_received', 'label': decision},
                    {'counter': 'alerts_dispatched', 'label': 'log'},
                    {'counter': 'alerts_dispatched',
                        'label': CASE decision WHEN 'decline' THEN 'dead_letter' ELSE 'webhook' END},
                    CASE decision WHEN 'decline' THEN {'counter': 'alert_failures', 'label': 'webhook'} END]
                END, recursive := true)
            FROM (SELECT decision, seq % 16 IN (0, 7) AS fine FROM dec)) WHERE counter IS NOT NULL
        GROUP BY ALL""",
        "dec",
    ),
)
def q_sink_counters(spark, sf_dir):
    """Stored, unreadable, dispatched and undelivered, counted from what happened to broken messages."""
    messages = contract.decode_decisions(derived.faulty_decisions(spark, sf_dir))
    # What is counted, and the bodies that are delivered.
    routed = F.when(F.col("routed"), F.col("value")).alias("value")
    decoded = stored(messages.select("decision", "errors", "routed", routed))
    alerted = decoded.where("routed")
    quick = config.Settings(alert_backoff_seconds=0.0)
    outcomes = deliver_alerts(contract.valid(alerted).select("value"), _refuse_declined, quick)
    return monitoring.sink_counters(decoded, alerted, outcomes)
