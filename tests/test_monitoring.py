"""Counters, lag and alert conditions on hand-made series."""

import math
import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.operators import monitoring

START = datetime(2026, 1, 1, tzinfo=UTC)


def at(seconds):
    return START + timedelta(seconds=seconds)


def series(spark, values):
    """(series, seconds, value)"""
    rows = [(name, at(s), float(v)) for name, s, v in values]
    return spark.createDataFrame(rows, "s string, sampled_at timestamp, value double")


def local(moment):
    return int((moment - START.replace(tzinfo=None)).total_seconds())


@pytest.mark.parametrize(
    "high, committed, lag", [(100, 90, 10), (100, 100, 0), (100, -1, 0), (90, 100, 0)]
)
def test_lag(spark, high, committed, lag):
    ends = spark.createDataFrame([("t", 0, high)], "topic string, partition int, high long")
    commits = spark.createDataFrame(
        [("g", "t", 0, committed)], "group string, topic string, partition int, committed long"
    )
    assert monitoring.consumer_lag(ends, commits).first().lag == lag


def expected_increase(samples, window):
    """Growth between consecutive samples that both lie in (t - window, t]."""
    result = {}
    for t, _ in samples:
        inside = [(s, v) for s, v in samples if t - window < s <= t]
        if len(inside) > 1:
            result[t] = sum(
                b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:], strict=False)
            )
    return result


def test_increase_with_gaps_resets_and_hours(spark):
    rng = random.Random(1)
    samples, t, value = [], 0, 0
    for _ in range(300):
        t += rng.choice([15, 30, 60, 60, 400])
        value = 0 if rng.random() < 0.05 else value + rng.choice([0, 0, 1, 5])
        samples.append((t, value))
    frame = series(spark, [("a", t, v) for t, v in samples])
    found = {
        local(r.sampled_at): r["increase"]
        for r in monitoring.increase(frame, ["s"], 300).collect()
    }
    expected = expected_increase(samples, 300)
    assert {t: v for t, v in found.items() if v is not None} == pytest.approx(expected)
    assert set(found) == {t for t, _ in samples}


def ticks(spark, flags, step=60):
    rows = [("a", at(i * step), flag) for i, flag in enumerate(flags) if flag is not None]
    return spark.createDataFrame(rows, "s string, sampled_at timestamp, active boolean")


def test_condition_has_to_hold(spark):
    # 4 true, 1 false, 6 true with a missing evaluation after the third.
    flags = [True] * 4 + [False] + [True] * 3 + [None] + [True] * 3
    found = monitoring.sustained(ticks(spark, flags), ["s"], 120, 60).collect()
    assert sorted((local(r.sampled_at), local(r.active_since)) for r in found) == [
        (120, 0), (180, 0), (420, 300), (660, 540)
    ]


def test_condition_across_hours(spark):
    found = monitoring.sustained(ticks(spark, [True] * 130), ["s"], 300, 60).collect()
    assert len(found) == 125 and {local(r.active_since) for r in found} == {0}


def test_immediate_condition(spark):
    found = monitoring.sustained(ticks(spark, [True, False, True]), ["s"], 0, 60).collect()
    assert sorted(local(r.sampled_at) for r in found) == [0, 120]


def test_lag_alert_needs_sum_over_partitions_for_five_minutes(spark):
    rows = [
        ("g", "t", p, at(60 * m), 600) for m in range(1, 8) for p in (0, 1)
    ] + [("quiet", "t", 0, at(60 * m), 1000) for m in range(1, 8)]
    lags = spark.createDataFrame(
        rows, "group string, topic string, partition int, sampled_at timestamp, lag long"
    )
    found = monitoring.lag_alerts(lags).collect()
    assert {r["group"] for r in found} == {"g"}
    # Samples stay visible for five minutes, so ticks run from minute 1 to 11.
    assert sorted(local(r.sampled_at) // 60 for r in found) == [6, 7, 8, 9, 10, 11]


def test_stall_needs_traffic_and_time(spark):
    accepted = series(spark, [("api", 60 * m, 10 * m) for m in range(40)])
    scored = series(spark, [("det", 60 * m, min(m, 10)) for m in range(40)])
    found = monitoring.stall_alerts(scored, accepted, ["s"]).collect()
    # Flat from minute 10: the 10-minute increase is 0 from minute 19 on, then 5 minutes.
    assert min(local(r.sampled_at) // 60 for r in found) == 24
    idle = series(spark, [("api", 60 * m, 5) for m in range(40)])
    assert monitoring.stall_alerts(scored, idle, ["s"]).count() == 0


def test_failure_alert_ends_after_the_window(spark):
    failures = series(spark, [("f", 60 * m, 0 if m < 5 else 1) for m in range(20)])
    found = sorted(local(r.sampled_at) // 60 for r in
                   monitoring.failure_alerts(failures, ["s"]).collect())
    assert found == [5, 6, 7, 8]


def test_down_for_a_minute(spark):
    up = series(spark, [("x", 60 * m, v) for m, v in enumerate([1, 0, 1, 0, 0, 0])])
    found = sorted(local(r.sampled_at) // 60 for r in
                   monitoring.down_alerts(up, ["s"]).collect())
    assert found == [4, 5]


def test_histogram_is_cumulative(spark):
    frame = spark.createDataFrame([(0.005,), (0.01,), (0.3,), (1.0,)], "p double")
    found = [
        (r.le, r.bucket_count)
        for r in monitoring.histogram(frame, "p", (0.01, 0.5)).collect()
    ]
    assert found == [(0.01, 2), (0.5, 3), (math.inf, 4)]


def buckets(spark, counts):
    return spark.createDataFrame(
        [(float(le), c) for le, c in counts], "le double, bucket_count long"
    )


@pytest.mark.parametrize(
    "counts, quantile, expected",
    [
        ([(1, 0), (2, 10), (math.inf, 10)], 0.5, 1.5),
        ([(1, 4), (2, 8), (math.inf, 8)], 0.25, 0.5),
        ([(1, 4), (2, 8), (math.inf, 10)], 0.95, 2.0),
        ([(1, 0), (2, 0), (math.inf, 0)], 0.5, math.nan),
    ],
)
def test_bucket_quantile(spark, counts, quantile, expected):
    found = monitoring.bucket_quantile(buckets(spark, counts), quantile).first()[0]
    assert found == expected or (math.isnan(found) and math.isnan(expected))


def test_percentiles_pick_elements(spark):
    rng = random.Random(2)
    values = {g: sorted(rng.randrange(60) / 10 for _ in range(n)) for g, n in (("a", 1), ("b", 97))}
    frame = spark.createDataFrame(
        [(g, v) for g, vs in values.items() for v in vs], "g string, seconds double"
    )
    found = {r.g: (r.p50, r.p95, r.p99)
             for r in monitoring.latency_percentiles(frame, ["g"]).collect()}
    for g, vs in values.items():
        pick = [vs[min(len(vs) - 1, int(len(vs) * f))] for f in (0.5, 0.95, 0.99)]
        assert found[g] == tuple(pick)
    whole = monitoring.latency_percentiles(frame, []).first()
    everything = sorted(v for vs in values.values() for v in vs)
    assert whole.p50 == everything[int(len(everything) * 0.5)]


def test_throughput(spark):
    frame = spark.createDataFrame(
        [(at(0), at(1)), (at(1), at(4))], "started_at timestamp, finished_at timestamp"
    )
    assert monitoring.throughput(frame).first().per_second == 0.5
