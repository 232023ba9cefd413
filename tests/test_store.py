"""The decision table: latest wins, replays are harmless, constraints hold."""

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.operators import ops, store
from riskloom.plans.batch import decide

AT = datetime(2026, 1, 1, tzinfo=UTC)


def arrivals(spark, *rows):
    """(id, seconds of processed_at, arrival, risk)"""
    data = [(t, AT + timedelta(seconds=s), a, r) for t, s, a, r in rows]
    return spark.createDataFrame(
        data, "transaction_id string, processed_at timestamp, arrival long, risk_score int"
    )


def test_latest_wins_and_equal_times_go_to_the_later_arrival(spark):
    rows = arrivals(
        spark, ("a", 0, 1, 10), ("a", 5, 2, 20), ("a", 3, 3, 30), ("b", 7, 4, 40), ("b", 7, 5, 50)
    )
    found = {r.transaction_id: r.risk_score for r in store.latest_decisions(rows).collect()}
    assert found == {"a": 20, "b": 50}


def test_repeated_rows_leave_one_and_the_payload_is_not_aggregated(spark):
    rows = arrivals(spark, ("a", 0, 1, 10), ("a", 0, 1, 10), ("b", 1, 2, 20), ("c", 2, 3, 30), ("c", 1, 9, 31))
    latest = store.latest_decisions(rows.checkpoint())
    assert sorted((r.transaction_id, r.risk_score) for r in latest.collect()) == [("a", 10), ("b", 20), ("c", 30)]
    assert "SortAggregate" not in latest._jdf.queryExecution().executedPlan().toString()


def decided(make, *rows, processed=AT):
    rows = [
        {"transaction_id": f"00000000-0000-4000-8000-{i:012d}", "customer_id": f"c{i}", **row}
        for i, row in enumerate(rows)
    ]
    records = decide(make(*rows), processed_at=F.lit(processed), keep=("seq",))
    return store.store_rows(records).withColumnRenamed("seq", "arrival")


def test_store_row_types(make):
    row = store.as_json_columns(
        decided(make, {"amount": 3500.0, "merchant_category": "electronics"})
    )
    types = {f.name: f.dataType.simpleString() for f in row.schema}
    assert types["amount"] == "decimal(14,2)" and types["risk_score"] == "smallint"
    found = row.first()
    assert found.triggered_rules == '["high_amount","risky_merchant_amount"]'
    assert found.features.startswith('{"amount":3500.0,"transaction_count_5m":1,"is_new_device":f')


def test_amount_rounds_half_away_from_zero(spark):
    frame = spark.createDataFrame([(2.345,), (-2.345,)], "x double")
    found = [str(r[0]) for r in frame.select(F.col("x").try_cast(store.AMOUNT_TYPE)).collect()]
    assert found == ["2.35", "-2.35"]


def test_violations_are_named(make):
    rows = decided(make, {}, {}).withColumns(
        {
            "risk_score": F.when(F.col("arrival") == 0, 101).otherwise(F.col("risk_score")),
            "currency": F.when(F.col("arrival") != 1, F.col("currency")),
        }
    )
    found = sorted((r.transaction_id[-1], r.violation) for r in store.violations(rows).collect())
    assert found == [("0", "risk_score_range"), ("1", "currency_not_null")]
    with pytest.raises(Exception, match="constraint broken"):
        store.enforce(rows).collect()


def test_rows_of_an_older_layout_get_the_default(make):
    rows = decided(make, {"amount": 3000.0}, {"amount": 3000.0})
    older = rows.where("arrival = 0").drop("rule_risk_score")
    both = store.join_versions(older, rows.where("arrival = 1"))
    assert {r.arrival: r.rule_risk_score for r in both.collect()} == {0: 0, 1: 60}


def as_set(table):
    return sorted(
        (r.transaction_id[-3:], r.risk_score, r.processed_at)
        for r in table.select("transaction_id", "risk_score", "processed_at").collect()
    )


def test_table_over_batches_and_replays(make, spark, tmp_path):
    root = str(tmp_path / "table")
    first = decided(make, {}, {"amount": 3000.0}, {"amount": 4000.0})
    store.upsert(first, root)
    # A later and an earlier decision for known transactions, and a new transaction.
    changed = decided(make, {"amount": 9000.0}, processed=AT + timedelta(seconds=9))
    stale = decided(make, {}, {"amount": 1.0}, processed=AT - timedelta(seconds=9))
    store.upsert(changed, root)
    store.upsert(stale.where("arrival = 1"), root)
    expected = as_set(store.read_table(spark, root))
    assert [(key, risk) for key, risk, _ in expected] == [("000", 60), ("001", 60), ("002", 60)]

    store.upsert(changed, root)
    store.upsert(first, root)  # a replay from the start
    assert as_set(store.read_table(spark, root)) == expected
    store.upsert(stale, root)
    more = decided(make, {}, {}, {}, {}).where("arrival = 3")
    store.upsert(more, root)
    assert as_set(store.read_table(spark, root))[:3] == expected
    assert store.read_table(spark, root).count() == 4
    store.upsert(first.limit(0), root)
    assert store.read_table(spark, root).count() == 4


def test_only_touched_partitions_are_rewritten(make, spark, tmp_path):
    root = tmp_path / "table"
    store.upsert(decided(make, *[{} for _ in range(40)]), str(root))
    before = {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")}
    store.upsert(decided(make, {"amount": 9000.0}, processed=AT + timedelta(seconds=9)), str(root))
    after = {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")}
    gone = {p.parent.name for p in before.keys() - after.keys()}
    assert len(gone) == 1 and len({p.parent.name for p in after}) == len({p.parent.name for p in before})
    assert all(after[p] == t for p, t in before.items() if p in after)


def test_a_batch_that_failed_midway_is_finished_from_its_staging(make, spark, tmp_path):
    root, staging = str(tmp_path / "table"), str(tmp_path / "staged")
    rows = decided(make, *[{} for _ in range(30)])
    store.upsert(rows.where("arrival < 20"), root, f"{staging}/0")
    store.upsert(rows.where("arrival >= 10"), root, f"{staging}/1")
    whole = as_set(store.read_table(spark, root))
    # As after a failure between the removal of a partition and its replacement.
    lost = sorted((tmp_path / "table").glob("bucket=*"))[0]
    for file in lost.iterdir():
        file.unlink()
    assert as_set(store.read_table(spark, root)) != whole
    store.upsert(rows.where("arrival >= 10"), root, f"{staging}/1")
    store.upsert(rows.where("arrival < 20"), root, f"{staging}/again")
    assert as_set(store.read_table(spark, root)) == whole


def test_a_stored_batch_is_copied_once_at_most(make, spark, tmp_path, monkeypatch):
    """No copies beside the staged rows, and these meet in one exchange, without a join."""
    rows = decided(make, *[{} for _ in range(30)]).checkpoint()
    copies = []
    monkeypatch.setattr(store, "stored", lambda df: copies.append(df) or df.checkpoint())
    root = str(tmp_path / "table")
    for low in (0, 10):
        store.upsert(rows.where(F.col("arrival") >= low), root, is_stored=True)
    assert not copies
    assert store.read_table(spark, root).count() == 30
    merged = store._merged(rows.withColumn("bucket", store._bucket(F.col("transaction_id"))), 30)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_buckets_over_several_tasks_and_ids_with_very_many_copies(make, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "BUCKETS", 2)
    monkeypatch.setattr(store, "ROWS_PER_PIECE", 20)
    found = decided(make, {}).crossJoin(spark.range(300).select("id")).withColumns(
        {
            "transaction_id": F.concat(F.lit("t"), F.when(F.col("id") < 200, F.col("id")).otherwise(7)),
            "processed_at": F.timestamp_seconds(1_767_225_600 + F.col("id") % 250),
            "arrival": F.col("id"),
        }
    )
    root = str(tmp_path / "table")
    store.upsert(found, root)
    assert store._sizes(found)[1] > store.ROWS_PER_PIECE
    first = {r.transaction_id: r.arrival for r in store.read_table(spark, root).collect()}
    assert first == {f"t{i}": i for i in range(200)} | {"t7": 249}
    assert store.read_table(spark, root).count() == 200
    store.upsert(found.withColumn("arrival", F.col("arrival") + 1000).where("id >= 100"), root)
    second = {r.transaction_id: r.arrival for r in store.read_table(spark, root).collect()}
    assert second == {f"t{i}": i if i < 100 else i + 1000 for i in range(200)} | {"t7": 1249}
    with pytest.raises(Exception, match="constraint broken"):
        store.upsert(found.withColumn("processed_at", F.lit(None).cast("timestamp")), root)


def test_a_first_batch_that_failed_before_its_end_is_written_by_its_retry(make, spark, tmp_path):
    root = tmp_path / "table"
    (root / ".spark-staging-1").mkdir(parents=True)
    rows = decided(make, {}, {})
    store.upsert(rows.limit(0), str(root), str(tmp_path / "staged"))
    assert not list(root.glob("bucket=*"))
    store.upsert(rows, str(root), str(tmp_path / "staged"))
    assert store.read_table(spark, str(root)).count() == 2


def test_an_older_table_gets_the_rule_score(make, spark, tmp_path):
    root = str(tmp_path / "table")
    rows = decided(make, {"amount": 3000.0}, {"amount": 3000.0})
    store.upsert(rows, root)
    older = str(tmp_path / "older")
    spark.read.parquet(root).drop("rule_risk_score").write.partitionBy("bucket").parquet(older)
    store.upsert(rows.where("arrival = 1").withColumn("processed_at", F.lit(AT + timedelta(seconds=5))), older)
    store.upsert(decided(make, {}, {}, {}).where("arrival = 2"), older)
    found = spark.read.option("mergeSchema", "true").parquet(older)
    assert found.count() == 3 and {r.arrival: r.rule_risk_score for r in found.collect()}[1] == 60


def test_empty_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        store.read_table(spark, str(tmp_path / "none"))


def test_bits_are_taken_in_turn(spark):
    rows = spark.createDataFrame([(a, b) for a in range(8) for b in range(4)], "a int, b int")
    found = rows.withColumn("z", store.interleaved((F.col("a"), 3), (F.col("b"), 2))).collect()
    for r in found:
        a, b = f"{r.a:03b}", f"{r.b:02b}"
        assert r.z == int(a[0] + b[0] + a[1] + b[1] + a[2], 2)


def test_filters_reach_partitions_and_files(make, spark, tmp_path):
    root = str(tmp_path / "table")
    store.upsert(decided(make, {}, {"amount": 3000.0}), root)
    wanted = "00000000-0000-4000-8000-000000000001"
    found = ops.decision_lookup(store.lookup_table(spark, root, wanted), wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(transaction_id" in plan
    assert found.first().decision == "review"


def test_one_layout_serves_all_access_paths(make, spark, tmp_path, monkeypatch):
    """Row groups whose statistics admit a filter: by time, by decision and time, by risk."""
    # As many row groups to a partition as a large table has.
    monkeypatch.setattr(store, "BUCKETS", 2)
    from pyarrow import parquet

    rows = decided(make, {}).crossJoin(spark.range(30_000).select("id")).withColumns(
        {
            "transaction_id": F.concat(F.lit("t"), F.col("id")),
            "event_time": F.timestamp_seconds(1_767_225_600 + F.pmod(F.xxhash64("id"), F.lit(86_400))),
            "risk_score": F.pmod(F.xxhash64("id", F.lit(1)), F.lit(101)).cast("smallint"),
        }
    )
    outcome = F.when(F.col("risk_score") >= 70, "decline").when(F.col("risk_score") >= 40, "review").otherwise("approve")
    root = tmp_path / "table"
    store.upsert(rows.withColumn("decision", outcome), str(root), **{"parquet.block.size": str(16 * 1024)})
    groups = []
    for file in root.rglob("*.parquet"):
        meta = parquet.ParquetFile(file).metadata
        names = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = {n: meta.row_group(g).column(names[n]).statistics for n in ("event_time", "risk_score", "decision")}
            groups.append({n: (s.min, s.max) for n, s in stats.items()})
    start = datetime(2026, 1, 1, 6)
    end = datetime(2026, 1, 1, 8)

    def in_time(g):
        low, high = (t.replace(tzinfo=None) for t in g["event_time"])
        return low < end and high >= start

    def share(admits):
        return sum(map(admits, groups)) / len(groups)

    assert len(groups) > 100
    assert share(in_time) < 0.4
    assert share(lambda g: in_time(g) and g["decision"][0] <= "decline" <= g["decision"][1]) < 0.2
    assert share(lambda g: g["risk_score"][1] >= 95) < 0.3


def decisions(spark, *rows):
    """(id, decision, label)"""
    return spark.createDataFrame(
        [(i, d, l, AT + timedelta(seconds=20 * n)) for n, (i, d, l) in enumerate(rows)],
        "transaction_id string, decision string, simulation_is_fraud boolean, event_time timestamp",
    )


def test_summary(spark):
    rows = decisions(
        spark, ("a", "approve", True), ("b", "decline", True), ("c", "review", False),
        ("d", "approve", None),
    )
    row = ops.ops_summary(rows).first()
    assert (row.transactions, row.alert_rate, row.declined, row.recall) == (4, 50.0, 1, 50.0)


def test_summary_without_fraud_or_rows(spark):
    assert ops.ops_summary(decisions(spark, ("a", "decline", None))).first().recall == 0.0
    empty = ops.ops_summary(decisions(spark, ("a", "x", None)).limit(0)).first()
    assert (empty.transactions, empty.alert_rate, empty.recall) == (0, 0.0, 0.0)


def test_mix_and_volume(spark):
    rows = decisions(spark, *[(str(i), "approve", None) for i in range(4)], ("z", "review", None))
    mix = [(r.decision, r.transactions) for r in ops.decision_mix(rows).collect()]
    assert mix == [("approve", 4), ("review", 1)]
    volume = {(r.minute.minute, r.decision): r.transactions
              for r in ops.volume_by_minute(rows).collect()}
    assert volume == {(0, "approve"): 3, (1, "approve"): 1, (1, "review"): 1}
