"""The streaming jobs over file topics: parity with batch, restart, replay, delivery."""

import json
import time
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskloom.config import Settings
from riskloom.functions.contract import decode_decisions, decode_transactions, valid
from riskloom.operators import dead_letter, store
from riskloom.plans.batch import decide
from riskloom.sources.topics import Topics
from riskloom.streaming import jobs
from riskloom.streaming.counters import read_counters, start_counters
from riskloom.streaming.delivery import attempt, attempt_all, deliver_alerts
from riskloom.streaming.pipeline import start_pipeline
from riskloom.streaming.progress import batch_durations, record_progress

from conftest import BASE
from test_features import fold, random_events

RAW, SCORED, DEAD = "transactions.raw", "transactions.scored", "transactions.dead_letter"


def message(event):
    seq, customer, time, device, country = event
    body = {k: v for k, v in BASE.items() if k not in ("label", "event_time", "transaction_id")}
    body |= {
        "transaction_id": f"00000000-0000-4000-8000-{seq:012d}", "customer_id": customer,
        "event_time": time.isoformat(), "device_id": device, "country_code": country,
        "amount": 3000.0 if seq % 9 == 0 else 25.5,
    }
    return body


def publish(spark, topics, bodies, first=0):
    """One file per call; offsets go on from `first`."""
    stamp = datetime(2026, 1, 1, tzinfo=UTC)
    rows = [
        (b"k", (b if isinstance(b, bytes) else json.dumps(b).encode()), 0, first + i, stamp)
        for i, b in enumerate(bodies)
    ]
    frame = spark.createDataFrame(
        rows, "key binary, value binary, partition int, offset long, timestamp timestamp"
    )
    topics.append(frame.coalesce(1), RAW, ordered=True)


def finish(queries):
    for query in queries if isinstance(queries, tuple) else (queries,):
        query.awaitTermination()
        assert query.exception() is None


@pytest.fixture
def place(tmp_path):
    # One file per batch, so state crosses batches.
    return Topics(root=str(tmp_path / "topics"), files_per_batch=1), str(tmp_path)


def scored_features(spark, topics):
    rows = valid(decode_decisions(topics.table(spark, SCORED))).collect()
    return {
        r.offset: (
            r.features.transaction_count_5m, r.features.is_new_device, r.features.is_new_country
        )
        for r in rows
    }


def test_stream_is_the_fold_over_arrivals_across_batches_and_a_restart(spark, place):
    topics, root = place
    events = random_events(11, count=120, disorder=900, ties=True)
    publish(spark, topics, [message(e) for e in events[:50]], 0)
    finish(jobs.start_scoring(spark, topics, f"{root}/ck"))
    # The second run starts from the checkpoint and finds its state there.
    publish(spark, topics, [message(e) for e in events[50:]], 50)
    finish(jobs.start_scoring(spark, topics, f"{root}/ck"))
    assert scored_features(spark, topics) == fold(events)


@pytest.mark.parametrize("files", [1, 3, 200])
def test_stream_does_not_depend_on_the_files_of_a_batch(spark, tmp_path, files):
    topics = Topics(root=str(tmp_path / "topics"), files_per_batch=files, offsets_per_file=15)
    events = random_events(16, count=90, disorder=900, ties=True)
    stamp = datetime(2026, 1, 1, tzinfo=UTC)
    rows = [
        (b"k", json.dumps(message(e)).encode(), len(e[1]) % 3, i, stamp)
        for i, e in enumerate(events)
    ]
    schema = "key binary, value binary, partition int, offset long, timestamp timestamp"
    # Dealt over many tasks, as other jobs write their topics.
    topics.append(spark.createDataFrame(rows, schema).repartition(7), RAW, ordered=True)
    finish(jobs.start_scoring(spark, topics, f"{tmp_path}/ck"))
    assert scored_features(spark, topics) == fold(events)


def test_stream_equals_batch_on_ordered_input(spark, place):
    topics, root = place
    events = random_events(12, count=80)
    publish(spark, topics, [message(e) for e in events])
    query = jobs.start_scoring(spark, topics, f"{root}/ck")
    finish(query)
    times = jobs.processing_times(spark, query).agg(F.sum("events"), F.min("seconds")).first()
    assert times[0] == 80 and times[1] > 0
    assert sum(p["observedMetrics"]["decisions"].scored for p in query.recentProgress) == 80
    names = ["transaction_id", "risk_score", "rule_risk_score", "fraud_probability", "decision",
             "triggered_rules", "features", "detector_version"]
    streamed = decode_decisions(topics.table(spark, SCORED)).select(*names).collect()
    table = valid(decode_transactions(topics.table(spark, RAW))).withColumn("seq", F.col("offset"))
    batch = decide(table).select(*names).collect()
    assert sorted(streamed) == sorted(batch)


def test_every_job_on_one_set_of_topics(spark, place):
    topics, root = place
    events = random_events(13, count=60)
    poison = b"not-json-\xff"
    publish(spark, topics, [message(e) for e in events] + [poison, message(events[0]) | {"amount": -1}])
    ck = f"{root}/ck"
    finish(jobs.start_scoring(spark, topics, ck))
    finish(jobs.start_rejects(spark, topics, ck))
    finish(jobs.start_alert_routing(spark, topics, ck))
    finish(jobs.start_store(spark, topics, f"{root}/table", ck))
    finish(jobs.start_alert_log(spark, topics, f"{root}/lines", ck))

    table = store.read_table(spark, f"{root}/table")
    assert table.count() == 60
    flagged = table.where("decision != 'approve'").count()
    assert flagged >= 6
    lines = [r.value for r in spark.read.text(f"{root}/lines").collect()]
    assert len(lines) == flagged and all(line.startswith("FRAUD_ALERT ") for line in lines)

    letters = topics.table(spark, DEAD)
    bodies = {bytes(r.value) for r in letters.collect()}
    assert poison in bodies and len(bodies) == 2
    found = {(r.source, r.error): r.messages for r in dead_letter.profile(letters).collect()}
    assert found == {("detector", "body:json"): 1, ("detector", "amount:range"): 1}

    # The webhook refuses declined payments only.
    def deliver(payload):
        if '"decision":"decline"' in payload:
            raise RuntimeError("refused")

    quick = Settings(alert_backoff_seconds=0)
    finish(jobs.start_delivery(spark, topics, deliver, f"{root}/outcomes", ck, quick))
    outcomes = spark.read.parquet(f"{root}/outcomes")
    declined = table.where("decision = 'decline'").count()
    assert outcomes.where("delivered").count() == flagged - declined
    assert outcomes.where("not delivered and attempts = 3").count() == declined
    undelivered = dead_letter.profile(topics.table(spark, DEAD)).where(
        "source = 'alerter-webhook' and error = 'alert webhook delivery exhausted'"
    )
    assert (undelivered.agg(F.sum("messages")).first()[0] or 0) == declined


def test_one_job_feeds_all_sinks_and_reads_each_message_once(spark, place):
    topics, root = place
    events = random_events(17, count=80, disorder=900, ties=True)
    poison = [b"not-json", message(events[0]) | {"amount": -1}, b"\xff", message(events[1]) | {"customer_id": ""}]
    publish(spark, topics, [*map(message, events[:50]), *poison[:2]], 0)
    first = jobs_pipeline(spark, topics, f"{root}/table", f"{root}/ck")
    # The offsets of the rejects lie between; the second run starts from the checkpoint.
    publish(spark, topics, [*map(message, events[50:]), *poison[2:]], 100)
    second = jobs_pipeline(spark, topics, f"{root}/table", f"{root}/ck")
    assert sum(p["numInputRows"] for q in (first, second) for p in q.recentProgress) == 84

    scored = scored_features(spark, topics)
    expected = fold(events)
    assert scored == {(s if s < 50 else s + 50): v for s, v in expected.items()}
    table = store.read_table(spark, f"{root}/table")
    flagged = table.where("decision != 'approve'").count()
    assert table.count() == 80 and topics.table(spark, "fraud.alerts").count() == flagged
    letters = topics.table(spark, DEAD)
    found = {(r.source, r.error): r.messages for r in dead_letter.profile(letters).collect()}
    assert found == {
        ("detector", "body:json"): 2, ("detector", "amount:range"): 1, ("detector", "customer_id:length"): 1
    }
    assert {bytes(r.value) for r in letters.collect()} >= {b"not-json", b"\xff"}
    with pytest.raises(ValueError, match="every"):
        start_pipeline(spark, topics, f"{root}/table", f"{root}/ck", ttl_ms=1)


def jobs_pipeline(spark, topics, table, checkpoints):
    query = start_pipeline(spark, topics, table, checkpoints)
    finish(query)
    return query


def test_every_batch_is_recorded_however_many_there_are(spark, place):
    topics, root = place
    for start in range(0, 30, 10):  # a file each, and so a batch each
        publish(spark, topics, [message(e) for e in random_events(19, count=30)[start : start + 10]], start)
    listener = record_progress(spark, f"{root}/progress")
    query = jobs.start_scoring(spark, topics, f"{root}/ck")
    finish(query)
    assert listener.wait_for(query)
    spark.streams.removeListener(listener)
    found = batch_durations(spark, f"{root}/progress").collect()
    assert [(r.batch, r.events) for r in sorted(found, key=lambda r: r.batch)] == [(0, 10), (1, 10), (2, 10)]
    assert all(r.seconds > 0 and r.per_event == pytest.approx(r.seconds / 10) for r in found)


def test_counters_show_a_lost_alert_and_go_on_after_a_restart(spark, place):
    topics, root = place
    events = random_events(18, count=30)

    def counted():
        finish(start_counters(spark, topics, f"{root}/counters", f"{root}/ck"))
        return {(r.counter, r.label): r.value for r in read_counters(spark, f"{root}/counters").collect()}

    assert counted() == {}
    publish(spark, topics, [*map(message, events[:20]), b"not-json"])
    jobs_pipeline(spark, topics, f"{root}/table", f"{root}/ck")
    first = counted()
    scored = {label: n for (counter, label), n in first.items() if counter == "detector_transactions"}
    received = {label: n for (counter, label), n in first.items() if counter == "alerts_received"}
    assert sum(scored.values()) == 20 and received and first["detector_failures", "validation"] == 1
    assert received == {label: n for label, n in scored.items() if label != "approve"}
    # A decision that never reaches the alert topic, and an alert that could not be delivered.
    other = topics.table(spark, SCORED).where("value LIKE '%review%' OR value LIKE '%decline%'").limit(1)
    topics.append(spark.createDataFrame(other.collect(), other.schema), SCORED)
    letters = dead_letter.dead_letters(other, source="alerter-webhook", error="x", keep=("partition", "offset"))
    topics.append(spark.createDataFrame(letters.collect(), letters.schema), DEAD)
    second = counted()
    assert sum(n for (c, _), n in second.items() if c == "detector_transactions") == 21
    assert {label: n for (c, label), n in second.items() if c == "alerts_received"} == received
    assert second["alert_failures", "webhook"] == 1


def test_unreadable_decisions_are_dead_letters_of_the_store(spark, place):
    topics, root = place
    publish(spark, topics, [message(e) for e in random_events(14, count=5)])
    finish(jobs.start_scoring(spark, topics, f"{root}/ck"))
    broken = topics.table(spark, SCORED).withColumn("value", F.lit("{}").cast("binary"))
    # Through a stream of its own: a file sink only shows files it wrote itself.
    other = Topics(root=f"{root}/other")
    other.append(broken, SCORED)
    finish(jobs.start_store(spark, other, f"{root}/table", f"{root}/other-ck"))
    found = dead_letter.profile(other.table(spark, DEAD)).first()
    assert found.source == "decision-store" and found.messages == 5
    assert "transaction_id:missing" in found.error


def test_the_store_decodes_each_message_once(spark, place):
    topics, root = place
    publish(spark, topics, [message(e) for e in random_events(20, count=30)])
    finish(jobs.start_scoring(spark, topics, f"{root}/ck"))
    scored = topics.table(spark, SCORED).withColumn("value", F.when(F.col("offset") % 3 == 0, b"{}").otherwise(F.col("value")))
    other = Topics(root=f"{root}/other")
    other.append(scored, SCORED)
    queries = jobs.start_store(spark, other, f"{root}/table", f"{root}/other-ck")
    finish(queries)
    assert len(queries) == 1
    assert store.read_table(spark, f"{root}/table").count() == 20
    letters = other.table(spark, DEAD).collect()
    assert sorted(r.offset for r in letters) == list(range(0, 30, 3)) and {bytes(r.value) for r in letters} == {b"{}"}


def test_repeated_run_changes_nothing(spark, place):
    topics, root = place
    publish(spark, topics, [message(e) for e in random_events(15, count=30)])
    for run in ("a", "b"):
        # A new checkpoint reads the scored topic from the start again.
        finish(jobs.start_scoring(spark, topics, f"{root}/ck"))
        finish(jobs.start_store(spark, topics, f"{root}/table", f"{root}/ck-{run}"))
        assert store.read_table(spark, f"{root}/table").count() == 30


def test_replay_with_limit_resume_and_dry_run(spark, place):
    topics, root = place
    publish(spark, topics, [b"bad-%d" % i for i in range(5)])
    finish(jobs.start_rejects(spark, topics, f"{root}/ck"))
    ledger = f"{root}/ledger"
    assert jobs.replay(spark, topics, ledger, target="again", dry_run=True).count() == 5
    first = jobs.replay(spark, topics, ledger, target="again", limit=2)
    assert sorted(bytes(r.value) for r in first.collect()) == [b"bad-0", b"bad-1"]
    jobs.replay(spark, topics, ledger, target="again")
    again = topics.table(spark, "again").collect()
    assert sorted(bytes(r.value) for r in again) == [b"bad-%d" % i for i in range(5)]
    assert all(r.headers is None and bytes(r.key) == b"k" for r in again)
    assert jobs.replay(spark, topics, ledger, target="again", dry_run=True).count() == 0


def test_messages_rejected_twice_are_replayed_twice(spark, place):
    topics, root = place
    publish(spark, topics, [b"bad-0", b"bad-1"])
    for run in range(3):
        finish(jobs.start_rejects(spark, topics, f"{root}/ck"))
        sent = jobs.replay(spark, topics, f"{root}/ledger")
        assert sorted(bytes(r.value) for r in sent.collect()) == [b"bad-0", b"bad-1"], run
    assert topics.table(spark, RAW).select("offset").distinct().count() == 8


def test_outcomes_of_a_new_checkpoint_do_not_replace_older_ones(spark, place):
    topics, root = place
    publish(spark, topics, [message(e) for e in random_events(17, count=30)])
    finish(jobs.start_scoring(spark, topics, f"{root}/ck"))
    finish(jobs.start_alert_routing(spark, topics, f"{root}/ck"))
    counts = []
    for run in ("a", "b"):
        finish(jobs.start_delivery(spark, topics, lambda _: None, f"{root}/out", f"{root}/ck-{run}"))
        counts.append(spark.read.parquet(f"{root}/out").count())
    assert counts[0] > 0 and counts[1] == 2 * counts[0]


def test_attempts_wait_longer_each_time():
    calls, waits = [], []

    def failing(times):
        def deliver(payload):
            calls.append(payload)
            if len(calls) <= times:
                raise RuntimeError

        return deliver

    assert attempt(failing(2), "x", 3, 0.5, waits.append) == (3, True)
    assert waits == [0.5, 1.0]
    calls.clear(), waits.clear()
    assert attempt(failing(9), "x", 3, 0.5, waits.append) == (3, False)
    assert len(calls) == 3 and waits == [0.5, 1.0]


def test_failed_alerts_share_one_wait():
    calls, waits = [], []

    def deliver(payload):
        calls.append(payload)
        if payload == "never" or (payload == "late" and calls.count("late") < 2):
            raise RuntimeError

    found = attempt_all(deliver, ["never", "now", "late"], 3, 0.5, waits.append)
    assert found == [(3, False), (1, True), (2, True)]
    assert waits == [0.5, 1.0] and calls.count("now") == 1


def test_delivery_keeps_every_alert(spark):
    frame = spark.range(50).select("id", F.col("id").cast("string").cast("binary").alias("value"))

    def deliver(payload):
        if int(payload) % 2:
            raise RuntimeError

    found = deliver_alerts(frame.repartition(4), deliver, Settings(alert_backoff_seconds=0))
    rows = {r.id: (r.attempts, r.delivered) for r in found.collect()}
    assert rows == {i: (3, False) if i % 2 else (1, True) for i in range(50)}


def wait_for(spark, topics, count):
    for _ in range(60):
        time.sleep(1)
        if Path(topics.path(SCORED)).exists() and topics.table(spark, SCORED).count() >= count:
            return
    pytest.fail(f"no {count} decisions within a minute")


def test_state_can_expire(spark, place):
    topics, root = place
    start = datetime(2026, 1, 1, tzinfo=UTC)
    with pytest.raises(ValueError, match="every"):
        jobs.start_scoring(spark, topics, f"{root}/ck", ttl_ms=1)
    publish(spark, topics, [message((0, "c", start, "d", "US"))])
    query = jobs.start_scoring(spark, topics, f"{root}/ck", ttl_ms=1, every="1 second")
    try:
        wait_for(spark, topics, 1)
        publish(spark, topics, [message((1, "c", start + timedelta(seconds=5), "e", "GB"))], 1)
        wait_for(spark, topics, 2)
    finally:
        query.stop()
    assert scored_features(spark, topics)[1] == (1, False, False)
