"""Values at places against a sort, with ties, skewed values, weights, nulls and ranges that need several rounds."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import monitoring, selection

PLACES = {
    "first": lambda size: F.lit(0),
    "middle": lambda size: F.floor(size / 2),
    "last": lambda size: size - 1,
    "beyond": lambda size: size,
}


def expected(values):
    values = sorted(values)
    return values[0], values[len(values) // 2], values[-1], None


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(4)
    return {
        "even": [float(i) for i in range(5_000)],
        "wide": [10 ** rng.uniform(-300, 300) * rng.choice((-1, 1)) for _ in range(5_000)],
        "tied": [1.0] * 4_000 + [rng.random() * 2 for _ in range(300)],
        "two": [0.0] * 700 + [1.0] * 700,
        "one": [3.5],
        None: [rng.gauss(0, 1) for _ in range(900)],
    }


@pytest.mark.parametrize("rows_sorted", [selection.SORTED, 40, 1])
def test_values_equal_a_sort(spark, groups, monkeypatch, rows_sorted):
    monkeypatch.setattr(selection, "SORTED", rows_sorted)
    rows = [(g, v) for g, values in groups.items() for v in values] + [("even", None), ("none", None)]
    random.Random(1).shuffle(rows)
    # The column names are those that the operator uses inside.
    frame = spark.createDataFrame(rows, "group string, value double").withColumn("low", F.lit(1)).repartition(5)
    found = selection.values_at(frame, ["group"], F.col("value"), PLACES).collect()
    assert {r["group"]: (r["first"], r["middle"], r["last"], r["beyond"]) for r in found} == {
        g: expected(values) for g, values in groups.items()
    }


def test_weights_count_as_copies(spark, monkeypatch):
    monkeypatch.setattr(selection, "SORTED", 10)
    rng = random.Random(2)
    pairs = [(rng.randrange(400), rng.choice((1, 1, 2, 500))) for _ in range(900)]
    frame = spark.createDataFrame(pairs, "v long, w int").repartition(4)
    found = selection.values_at(frame, [], F.col("v"), PLACES, weight=F.col("w")).collect()
    assert [tuple(r) for r in found] == [expected([v for v, w in pairs for _ in range(w)])]


def test_empty_tables_have_no_groups(spark):
    frame = spark.createDataFrame([], "g string, v double")
    assert selection.values_at(frame, ["g"], F.col("v"), PLACES).collect() == []
    assert selection.values_at(frame, [], F.col("v"), PLACES).collect() == []


def test_only_a_small_range_is_sorted(spark, monkeypatch):
    frame = spark.range(200_000).select((F.col("id") % 3).alias("g"), F.rand(5).alias("seconds"))
    observed, inside = [], selection._inside

    def counted(rows, ranges):
        held = inside(rows, ranges)
        observed.append(held.count())
        return held

    monkeypatch.setattr(selection, "_inside", counted)
    assert monitoring.latency_percentiles(frame, ["g"]).count() == 3
    # Counted per cell first, then sorted: three places of 32 cells.
    assert observed[0] == 200_000 and observed[-1] < 200_000 * 4 / 32
