"""What the message contract accepts, rejects and normalises."""

import json

import pytest
from pyspark.sql import functions as F

from riskloom.functions import contract
from riskloom.functions.contract import (
    acceptance,
    check_transactions,
    decode_decisions,
    decode_transactions,
    rejected,
    to_message,
    valid,
)
from riskloom.functions.scoring import DECISION_COLUMNS
from riskloom.plans.batch import decide

BODY = {
    "customer_id": "c1", "card_id": "k1", "merchant_id": "m1", "merchant_category": "grocery",
    "amount": 25.5, "currency": "USD", "country_code": "US", "city": "Boston", "latitude": 42.36,
    "longitude": -71.05, "device_id": "d1", "ip_address": "198.51.100.1", "channel": "ecommerce",
    "event_time": "2026-01-01T00:00:00Z",
}


def body(**changes):
    return json.dumps(BODY | changes, ensure_ascii=False)


def without(name):
    return json.dumps({k: v for k, v in BODY.items() if k != name})


# name -> (body, expected errors)
CASES = {
    "plain": (body(), []),
    "unknown field": (body(risk_hint="x"), []),
    "amount zero": (body(amount=0), ["amount:range"]),
    "amount negative": (body(amount=-1), ["amount:range"]),
    "amount largest": (body(amount=1_000_000), []),
    "amount too large": (body(amount=1_000_000.01), ["amount:range"]),
    "amount huge integer": (body(amount=10**400), ["amount:range"]),
    "amount text": (body(amount=" 25.5 "), []),
    "amount java suffix": (body(amount="5f"), ["amount:type"]),
    "amount digit group": (body(amount="1_000"), ["amount:type"]),
    "amount boolean": (body(amount=True), ["amount:type"]),
    "amount NaN text": (body(amount="NaN"), ["amount:type"]),
    "amount missing": (without("amount"), ["amount:missing"]),
    "amount null": (body(amount=None), ["amount:type"]),
    "country three letters": (body(country_code="USA"), ["country_code:pattern"]),
    "country trailing newline": (body(country_code="US\n"), ["country_code:pattern"]),
    "country lower case": (body(country_code="us"), ["country_code:pattern"]),
    "latitude": (body(latitude=91), ["latitude:range"]),
    "latitude edge": (body(latitude=-90), []),
    "longitude": (body(longitude=180.5), ["longitude:range"]),
    "currency": (body(currency="JPY"), ["currency:choice"]),
    "channel": (body(channel="fax"), ["channel:choice"]),
    "identifier number": (body(customer_id=5), ["customer_id:type"]),
    "identifier blank": (body(customer_id=" \t "), ["customer_id:length"]),
    "identifier 64": (body(customer_id="x" * 64), []),
    "identifier 65": (body(customer_id="x" * 65), ["customer_id:length"]),
    "city emoji": (body(city="\U0001f600" * 100), []),
    "city long": (body(city="x" * 101), ["city:length"]),
    "naive time": (body(event_time="2026-01-01T00:00:00"), ["event_time:type"]),
    "date only": (body(event_time="2026-01-01"), ["event_time:type"]),
    "zone name": (body(event_time="2026-01-01T00:00:00 UTC"), ["event_time:type"]),
    "time offset": (body(event_time="2026-01-01 02:00:00+0200"), []),
    "time without seconds": (body(event_time="2026-01-01T00:00Z"), []),
    "epoch seconds": (body(event_time=1767225600), []),
    "epoch milliseconds": (body(event_time=1767225600000), []),
    "epoch text": (body(event_time="1767225600"), []),
    "uuid": (body(transaction_id="nope"), ["transaction_id:type"]),
    "uuid null": (body(transaction_id=None), ["transaction_id:type"]),
    "version": (body(schema_version="2.0"), ["schema_version:choice"]),
    "version number": (body(schema_version=1.0), ["schema_version:type"]),
    "version null": (body(schema_version=None), ["schema_version:type"]),
    "ipv6": (body(ip_address="::ffff:1.2.3.4"), []),
    "ipv6 scope": (body(ip_address="fe80::1%eth0"), []),
    "ipv6 too long": (body(ip_address="1:2:3:4:5:6:7:8:9"), ["ip_address:syntax"]),
    "ipv4 leading zero": (body(ip_address="01.2.3.4"), ["ip_address:syntax"]),
    "ipv4 range": (body(ip_address="256.1.1.1"), ["ip_address:syntax"]),
    "ip number": (body(ip_address=16909060), ["ip_address:type"]),
    "simulation null": (body(simulation=None), []),
    "simulation": (body(simulation={"is_fraud": True, "scenario": "x"}), []),
    "simulation word": (body(simulation={"is_fraud": "yes"}), []),
    "simulation two": (body(simulation={"is_fraud": 2}), ["simulation:type"]),
    "simulation empty": (body(simulation={}), ["simulation:type"]),
    "simulation text": (body(simulation="x"), ["simulation:type"]),
    "two errors": (body(amount=-1, latitude=91), ["amount:range", "latitude:range"]),
    "text": ("not json", ["body:json"]),
    "empty": ("", ["body:json"]),
    "array": ("[1]", ["body:json"]),
    "trailing text": (body() + " x", ["body:json"]),
    "second document": (body() + " " + body(), ["body:json"]),
    "closed early": (body() + "] [" + body(), ["body:json"]),
    "stray brace": (body() + "}", ["body:json"]),
    "repeated key": ('{"amount": 1, "amount": 2}', ["body:json"]),
}


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(name, text.encode(), 0, i) for i, (name, (text, _)) in enumerate(CASES.items())]
    messages = spark.createDataFrame(
        rows, "name string, value binary, partition int, offset long"
    )
    return {row["name"]: row for row in decode_transactions(messages).collect()}


@pytest.mark.parametrize("name", CASES)
def test_errors(decoded, name):
    assert decoded[name].errors == CASES[name][1]


def test_values_are_typed_and_normalised(decoded, spark):
    assert decoded["amount text"].amount == 25.5
    assert decoded["epoch seconds"].event_time == decoded["plain"].event_time
    assert decoded["epoch milliseconds"].event_time == decoded["plain"].event_time
    assert decoded["time offset"].event_time == decoded["plain"].event_time
    assert decoded["plain"].schema_version == "1.0"
    assert decoded["simulation"].simulation.scenario == "x"
    assert decoded["simulation word"].label is True
    assert decoded["plain"].label is None


def _decode_one(spark, text, offset=7):
    frame = spark.createDataFrame(
        [(text.encode() if isinstance(text, str) else text, 0, offset)],
        "value binary, partition int, offset long",
    )
    return decode_transactions(frame).first()


@pytest.mark.parametrize(
    "spelling",
    [
        "0A93D3EB-5FBD-4C4E-9736-27C7BE35AAF1",
        "0a93d3eb5fbd4c4e973627c7be35aaf1",
        "{0a93d3eb-5fbd-4c4e-9736-27c7be35aaf1}",
        "urn:uuid:0a93d3eb-5fbd-4c4e-9736-27c7be35aaf1",
    ],
)
def test_uuid_spellings(spark, spelling):
    row = _decode_one(spark, body(transaction_id=spelling))
    assert row.transaction_id == "0a93d3eb-5fbd-4c4e-9736-27c7be35aaf1"


def test_missing_id_is_the_same_on_every_reading(spark):
    first, again, other = (_decode_one(spark, body(), o).transaction_id for o in (7, 7, 8))
    assert first == again != other
    assert first[14] == "4" and first[19] == "8" and len(first) == 36


@pytest.mark.parametrize("space", [" ", " ", " ", "\t"])
def test_unicode_space_is_stripped(spark, space):
    assert _decode_one(spark, body(city=f"{space}Boston{space}")).city == "Boston"


def test_control_separator_is_not_space(spark):
    assert _decode_one(spark, body(city="\u001cBoston")).city == "\u001cBoston"


def test_invalid_utf8_is_rejected(spark):
    assert _decode_one(spark, b'{"a": "\xff"}').errors == ["body:json"]


def test_typed_rows_split_into_valid_and_rejected(make):
    checked = check_transactions(
        make({}, {"amount": -1.0}, {"country_code": "USA"}, {"transaction_id": "x", "latitude": 91.0})
    )
    assert [r.seq for r in valid(checked).collect()] == [0]
    found = {r.seq: r.errors for r in rejected(checked).collect()}
    assert found == {
        1: ["amount:range"],
        2: ["country_code:pattern"],
        3: ["transaction_id:syntax", "latitude:range"],
    }


def test_missing_typed_value(make):
    row = check_transactions(make({"customer_id": None, "amount": float("nan")})).first()
    assert row.errors == ["customer_id:missing", "amount:range"]


def test_acceptance_receipt(make):
    row = acceptance(valid(check_transactions(make({})))).first()
    assert row.status == "accepted" and row.accepted_at is not None


def _decision_messages(make, *rows):
    return to_message(decide(make(*rows)), "customer_id", DECISION_COLUMNS)


def test_decision_round_trip(make):
    records = decide(make({"amount": 5000.0, "merchant_category": "electronics"}))
    read = decode_decisions(to_message(records, "customer_id", DECISION_COLUMNS))
    assert read.first().errors == []
    # The clock is read again by each action.
    names = [n for n in DECISION_COLUMNS if n != "processed_at"]
    assert read.select(*names).first() == records.select(*names).first()


@pytest.mark.parametrize(
    "old, new, errors",
    [
        ('"risk_score":80', '"risk_score":101', ["risk_score:range"]),
        ('"risk_score":80', '"risk_score":80.5', ["risk_score:type"]),
        ('"risk_score":80', '"risk_score":80.0', []),
        ('"rule_risk_score":80,', "", []),
        ('"decision":"decline"', '"decision":"block"', ["decision:choice"]),
        ('"transaction_count_5m":1', '"transaction_count_5m":0', ["features:range"]),
        ('"is_new_device":false', '"is_new_device":"maybe"', ["features:type"]),
        ('"triggered_rules":[', '"triggered_rules":[1,', ["triggered_rules:type"]),
        ('"simulation_is_fraud":null', '"simulation_is_fraud":3', ["simulation_is_fraud:type"]),
    ],
)
def test_decision_errors(make, old, new, errors):
    messages = _decision_messages(make, {"amount": 5000.0, "merchant_category": "electronics"})
    text = F.replace(F.col("value").cast("string"), F.lit(old), F.lit(new))
    row = decode_decisions(messages.withColumn("value", text.cast("binary"))).first()
    assert old in messages.first().value.decode()
    assert row.errors == errors


def test_absent_rule_score_defaults_to_zero(make):
    messages = _decision_messages(make, {"amount": 5000.0, "merchant_category": "electronics"})
    text = F.replace(
        F.col("value").cast("string"), F.lit('"rule_risk_score":80,'), F.lit("")
    )
    row = decode_decisions(messages.withColumn("value", text.cast("binary"))).first()
    assert row.rule_risk_score == 0


def test_ids_stay_apart_beyond_twelve_digits(spark, tmp_path):
    from riskloom.sources.tables import transactions

    first = 10**12 - 2
    events = spark.range(first, first + 5).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id",
        "'view' AS event_type", "1.0 AS value", """'{"k": 1}' AS props""",
    )
    large = events.withColumn("event_id", F.col("event_id") * 9 * 10**6)
    events.unionByName(large).write.parquet(f"{tmp_path}/events.parquet")
    ids = [r.transaction_id for r in transactions(spark, str(tmp_path)).collect()]
    assert len(set(ids)) == 10 and {len(i) for i in ids} == {36}
    assert "00000000-0000-4000-8000-999999999998" in ids


def test_fields_are_found_in_one_pass_and_bodies_parsed_once(spark):
    bodies = [
        '{"a":[1]}', '{"a":[{"b":1}]}', "{}] {}", "{} \n] x", '{"a":"}]"}', "{},{}", "{}, 1] {", " {} ", '{"a":[]} [', "[{}]",
    ]
    rows = spark.createDataFrame([(i, b.encode()) for i, b in enumerate(bodies)], "n int, value binary")
    found = {r["n"] for r in contract._document(rows, "value").where("doc IS NOT NULL").collect()}
    assert found == {0, 1, 4, 7}
    decoded = contract.decode_decisions(rows)
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(doc#") == 1
