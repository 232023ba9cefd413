"""Every registered query against its SQL on the smallest tables."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF

duckdb = pytest.importorskip("duckdb")
import __spark_entry__ as entry_points  # noqa: E402
from riskloom.plans.queries import ORACLES, QUERIES  # noqa: E402


# A fit needs a thousand labelled rows.
LARGER = {"q_train_model": SF.replace("sf0.001", "sf0.01")}


def connect(sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    return connection


def plain(rows):
    def text(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value + 0.0)
        return str(value)

    return sorted(tuple(text(v) for v in row) for row in rows)


def test_every_oracle_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    sf_dir = LARGER.get(name, SF)
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    result = connect(sf_dir).execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [[row[i] for i in order] for row in result.fetchall()]
    assert plain(frame.select(*columns).collect()) == plain(expected)


def test_plans_of_lookup_and_lag(spark):
    def plan(name):
        return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()

    lookup = plan("q_decision_lookup")
    assert "PushedFilters: [IsNotNull(transaction_id), EqualTo(transaction_id" in lookup
    assert "Exchange" not in lookup
    # The running offsets read the table twice; the lag itself adds no scan.
    assert plan("q_consumer_lag").count("FileScan") == 2


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert {r.decision: r.transactions for r in rows} == {
        "approve": 848, "review": 62, "decline": 58
    }


def test_events_of_one_row_group_are_dealt_evenly(spark, tmp_path):
    """A file that is cut into many pieces, all of them empty but the one with the row group."""
    from riskloom.sources import tables

    rows = spark.range(20_000).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "id % 9 AS user_id", "'view' AS event_type",
        "rand(1) AS value", "sha2(CAST(id AS STRING), 256) AS props",
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        dealt = tables.events(spark, str(tmp_path))
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(sizes) == 20_000
    assert max(sizes) <= 1.5 * 20_000 / spark.sparkContext.defaultParallelism
