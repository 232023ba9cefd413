"""Velocity and first-seen flags against a plain fold over the events."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.config import Settings
from riskloom.operators.features import with_features

START = datetime(2026, 1, 1, tzinfo=UTC)
WINDOW = timedelta(seconds=300)


def fold(events):
    """(seq, customer, time, device, country) in processing order -> expected features."""
    times, devices, countries, expected = {}, {}, {}, {}
    for seq, customer, time, device, country in events:
        kept = [t for t in times.get(customer, []) if t >= time - WINDOW] + [time]
        times[customer] = kept
        seen_devices = devices.setdefault(customer, set())
        seen_countries = countries.setdefault(customer, set())
        expected[seq] = (
            len(kept),
            bool(seen_devices) and device not in seen_devices,
            bool(seen_countries) and country not in seen_countries,
        )
        seen_devices.add(device)
        seen_countries.add(country)
    return expected


def random_events(seed, count=400, step=40, disorder=0, ties=False):
    rng = random.Random(seed)
    time, events = START, []
    for seq in range(count):
        time += timedelta(seconds=0 if ties and rng.random() < 0.5 else rng.randrange(step))
        late = timedelta(seconds=rng.randrange(disorder + 1))
        # One customer owns most of the events.
        customer = "hot" if rng.random() < 0.6 else f"c{rng.randrange(6)}"
        events.append(
            (seq, customer, time - late, f"d{rng.randrange(5)}", rng.choice(["US", "GB", "CA"]))
        )
    return events


def as_rows(events):
    names = ("seq", "customer_id", "event_time", "device_id", "country_code")
    return [dict(zip(names, event, strict=True)) for event in events]


def derived(frame):
    return {
        r.seq: (r.transaction_count_5m, r.is_new_device, r.is_new_country) for r in frame.collect()
    }


# Small limits send the same rows through the paths for hot groups and many chunks.
TIGHT = Settings(hot_group_rows=10, arrival_chunk=37)


@pytest.mark.parametrize("settings", [Settings(), TIGHT], ids=["plain", "tight"])
@pytest.mark.parametrize("ties", [False, True])
def test_event_time_order_is_the_fold_over_sorted_events(make, settings, ties):
    events = random_events(1, ties=ties, disorder=600)
    result = with_features(make(*as_rows(events)), settings)
    assert derived(result) == fold(sorted(events, key=lambda e: (e[2], e[0])))


@pytest.mark.parametrize("settings", [Settings(), TIGHT], ids=["plain", "tight"])
@pytest.mark.parametrize("disorder", [0, 200, 2000])
def test_arrival_order_is_the_fold_over_arrivals(make, settings, disorder):
    events = random_events(2, disorder=disorder, ties=True)
    result = with_features(make(*as_rows(events)), settings, order="arrival")
    assert derived(result) == fold(events)


@pytest.mark.parametrize("clock", ["ahead", "back and forth", "still"])
def test_arrival_order_with_wrong_clocks(make, clock):
    """One event far ahead, times that jump, and all events at one instant: over many chunks, in several shares."""
    rng = random.Random(8)
    shift = {"ahead": lambda i: 10**6 if i == 5 else i, "back and forth": lambda i: 900 * (i % 3), "still": lambda i: 0}
    events = [
        (i, rng.choice(["hot", "hot", "c"]), START + timedelta(seconds=shift[clock](i) + rng.randrange(3)), f"d{i % 5}", "US")
        for i in range(400)
    ]
    result = with_features(make(*as_rows(events)), Settings(arrival_chunk=9), order="arrival")
    assert derived(result) == fold(events)


def test_a_window_of_two_thousand_chunks(make):
    """Survivors of every chunk outlive all the others; each is one row, and no row has a list."""
    events = [(i, "hot", START + timedelta(milliseconds=i), "d", "US") for i in range(2000)]
    events += [(2000 + i, "hot", START + timedelta(seconds=301 + i), "d", "US") for i in range(3)]
    result = with_features(make(*as_rows(events)), Settings(arrival_chunk=1), order="arrival")
    assert derived(result) == fold(events)
    # The payload is one struct; nothing else is nested.
    assert "array<" not in result._jdf.queryExecution().analyzed().toString()


def test_both_orders_agree_on_ordered_input(make):
    rows = make(*as_rows(random_events(3)))
    assert derived(with_features(rows)) == derived(with_features(rows, order="arrival"))


def test_dense_slot_is_spread_and_still_exact(make):
    """All events of one customer within one window, many at the same instant."""
    rng = random.Random(4)
    events = [
        (i, "hot", START + timedelta(seconds=rng.randrange(20)), f"d{i % 7}", "US")
        for i in range(500)
    ]
    result = with_features(make(*as_rows(events)), Settings(hot_group_rows=100))
    assert derived(result) == fold(sorted(events, key=lambda e: (e[2], e[0])))


def test_times_before_1970(make):
    old = datetime(1969, 12, 31, 23, 50, tzinfo=UTC)
    events = [(i, "c", old + timedelta(seconds=97 * i), "d", "US") for i in range(20)]
    assert derived(with_features(make(*as_rows(events)))) == fold(events)


@pytest.mark.parametrize("order", ["event_time", "arrival"])
def test_window_edge_is_inclusive(make, order):
    at = [timedelta(0), timedelta(seconds=300), timedelta(seconds=300, microseconds=1)]
    rows = make(*[{"event_time": START + shift} for shift in at])
    counts = [r.transaction_count_5m for r in with_features(rows, order=order).orderBy("seq").collect()]
    assert counts == [1, 2, 2]


def test_first_event_is_never_new_and_later_ones_are(make):
    rows = make({}, {"device_id": "other", "country_code": "GB"}, {"device_id": "other"})
    found = with_features(rows).orderBy("seq").collect()
    assert [(r.is_new_device, r.is_new_country) for r in found] == [
        (False, False),
        (True, True),
        (False, False),
    ]


def test_repeated_transactions_count_unless_told_otherwise(make):
    rows = make({}, {}, {})
    assert with_features(rows).agg(F.max("transaction_count_5m")).first()[0] == 3
    once = with_features(rows, distinct_by=["transaction_id"])
    assert once.agg(F.max("transaction_count_5m")).first()[0] == 1


def test_risky_categories(make):
    rows = make(*[{"merchant_category": c} for c in ("digital_goods", "electronics", "grocery")])
    found = with_features(rows).orderBy("seq").collect()
    assert [r.is_risky_merchant for r in found] == [True, True, False]


def test_unknown_order(make):
    with pytest.raises(ValueError, match="order"):
        with_features(make({}), order="random")


def test_payload_crosses_one_exchange(make):
    """The wide rows are shuffled once, by customer and slot."""
    plan = with_features(make({}, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(customer_id") == 2  # marks and rows
    assert "slot" in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan
