"""The decision table: one row per transaction, the latest decision wins.

A plain Parquet table partitioned by a hash of the transaction id.  A batch reads the partitions that its
ids fall into, takes the latest decision per id of both, and overwrites those partitions (Spark's dynamic
partition overwrite); all others stay as they are.  What a batch costs follows the partitions it touches, so
batches should be large beside their number (`BUCKETS`, one setting for the life of a table).

Rows are dealt by the id's hash, a bucket over as many tasks as its rows need, so all decisions on an id meet in
one exchange.  The merged rows are written to a staging folder first, because nothing that is being read may be
overwritten; the first batch of a table reads none of it and needs no staging.  A batch that is tried again with the
same staging folder finds them there and only repeats the overwrite, so a failure at any point leaves nothing lost.
One writer at a time.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.config import OUTCOMES
from riskloom.functions.shape import without_nulls
from riskloom.session import checkpoint_dir, stored

# Column widths of the table.
DETECTOR_VERSION_LENGTH = 50
CUSTOMER_ID_LENGTH = 64
CURRENCY_LENGTH = 3
AMOUNT_TYPE = "decimal(14,2)"
# More than any arrival number, so one decimal holds (time, arrival) in order.
ARRIVAL_RANGE = "10000000000000000000BD"
# Partitions of the table, and how finely rows are ordered inside one.
BUCKETS = 64
DECISION_BITS, TIME_BITS, RISK_BITS = 2, 10, 7
# Rows that one task merges and sorts, and the parts of a bucket that are counted to find ids with too many copies for it.
ROWS_PER_PIECE = 500_000
CELLS = 1024


def store_rows(decisions: DataFrame) -> DataFrame:
    """Decision records in the table's types; rules and features stay native."""
    return decisions.withColumns(
        {
            "amount": F.col("amount").try_cast(AMOUNT_TYPE),
            "risk_score": F.col("risk_score").cast("smallint"),
            "rule_risk_score": F.col("rule_risk_score").cast("smallint"),
        }
    ).drop("schema_version", "errors")


def as_json_columns(rows: DataFrame) -> DataFrame:
    """Rules and features as JSON text."""
    return rows.withColumns(
        {"triggered_rules": F.to_json("triggered_rules"), "features": F.to_json("features")}
    )


def constraint_conditions() -> dict[str, Column]:
    """Table constraint -> condition that every row has to meet."""
    required = (
        "transaction_id",
        "customer_id",
        "event_time",
        "amount",
        "currency",
        "risk_score",
        "rule_risk_score",
        "fraud_probability",
        "decision",
        "triggered_rules",
        "features",
        "detector_version",
        "processed_at",
    )
    present = {f"{name}_not_null": F.col(name).isNotNull() for name in required}
    domains = {
        "risk_score_range": F.col("risk_score").between(0, 100),
        "rule_risk_score_range": F.col("rule_risk_score").between(0, 100),
        "fraud_probability_range": F.col("fraud_probability").between(0, 1),
        "decision_domain": F.col("decision").isin(*OUTCOMES),
        "customer_id_width": F.char_length("customer_id") <= CUSTOMER_ID_LENGTH,
        "currency_width": F.char_length("currency") <= CURRENCY_LENGTH,
        "detector_version_width": F.char_length("detector_version") <= DETECTOR_VERSION_LENGTH,
    }
    # As in a database, a null passes a range check; the not-null constraint reports it.
    return present | {name: F.coalesce(ok, F.lit(True)) for name, ok in domains.items()}


def violations(rows: DataFrame) -> DataFrame:
    """transaction_id and the name of each broken constraint."""
    broken = [F.when(~ok, F.lit(name)) for name, ok in constraint_conditions().items()]
    return rows.select("transaction_id", F.explode(without_nulls(*broken)).alias("violation"))


def enforce(rows: DataFrame) -> DataFrame:
    """Fails the job on the first broken constraint, as an insert would."""
    failure = F.lit(None).cast("string")
    for name, ok in reversed(constraint_conditions().items()):
        failure = F.when(~ok, F.lit(f"decision table constraint broken: {name}")).otherwise(failure)
    return rows.where(F.when(failure.isNull(), True).otherwise(F.raise_error(failure)))


def latest_decisions(rows: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Latest processed_at per transaction, the later arrival on equal times; of repeated rows, one.

    Time and arrival are packed into one number, whose maximum is aggregated by hash and combined before the
    shuffle, however many copies there are.  The payload takes no part in it: rows of ids that occur once pass a
    join with the repeated ids, which Spark sends whole where it finds them small, and only the others are compared.
    `rows` are read several times: pass a stored table.
    """
    order = F.expr(f"CAST(unix_micros(processed_at) AS DECIMAL(20, 0)) * {ARRIVAL_RANGE} + {arrival}")
    tops = rows.select("transaction_id", order.alias("_top")).groupBy("transaction_id")
    repeated = stored(
        tops.agg(F.max("_top").alias("_top"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    )
    once = rows.join(repeated, "transaction_id", "left_anti")
    newest = rows.withColumn("_top", order).join(repeated, ["transaction_id", "_top"], "left_semi")
    one = Window.partitionBy("transaction_id").orderBy("_top")
    first = newest.withColumn("_row", F.row_number().over(one)).where("_row = 1")
    return once.select(*rows.columns).unionByName(first.select(*rows.columns))


def with_rule_score(rows: DataFrame) -> DataFrame:
    """Rows written before rule_risk_score existed get its default."""
    known = F.col("rule_risk_score") if "rule_risk_score" in rows.columns else F.lit(None)
    return rows.withColumn(
        "rule_risk_score", F.coalesce(known.cast("smallint"), F.lit(0).cast("smallint"))
    )


def join_versions(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Rows of an older and a newer table layout under the newer one."""
    return with_rule_score(newer.unionByName(older, allowMissingColumns=True))


# --- the table -----------------------------------------------------------------------------------


def _bucket(transaction_id: Column) -> Column:
    return F.pmod(F.xxhash64(transaction_id), F.lit(BUCKETS)).cast("int")


def _part(transaction_id: Column, parts: int) -> Column:
    """Which of so many parts of its bucket an id falls into, by other bits of the hash than the bucket."""
    return F.pmod(F.shiftrightunsigned(F.xxhash64(transaction_id), 32), F.lit(parts)).cast("int")


def _exists(spark: SparkSession, pattern: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place))


def interleaved(*dimensions: tuple[Column, int]) -> Column:
    """One number from whole numbers of so many bits each, their bits taken in turn from the highest one.

    Rows close in this order are close in every dimension, so the statistics of a stretch of rows are narrow for
    all of them, where an ordinary sort order serves its first column alone.
    """
    owners = [
        (d, level)
        for level in range(max(bits for _, bits in dimensions))
        for d, (_, bits) in enumerate(dimensions)
        if level < bits
    ]
    place = {owner: len(owners) - 1 - position for position, owner in enumerate(owners)}
    key = F.lit(0).cast("long")
    for d, (value, bits) in enumerate(dimensions):
        # What each value adds to the key, as a table of 2**bits numbers: one lookup a row.
        spread = [
            sum(1 << place[d, level] for level in range(bits) if number >> (bits - 1 - level) & 1)
            for number in range(2**bits)
        ]
        key = key + F.get(F.lit(spread).cast("array<long>"), value.cast("int"))
    return key


def _laid_out(rows: DataFrame, source: DataFrame) -> DataFrame:
    """Rows sorted inside their partition by decision, risk and time alike, as they are asked for by each.

    The range of times is read from `source`, which has all times of `rows`.
    """
    ends = source.agg(F.min("event_time").alias("low"), F.max("event_time").alias("high"))
    low, high = ends.select(F.unix_micros("low"), F.unix_micros("high")).first()
    steps = 2**TIME_BITS - 1
    span = max((high or 0) - (low or 0), 1)
    time = F.floor((F.unix_micros("event_time") - F.lit(low or 0)) / F.lit(span) * steps)
    risk = F.floor(F.col("risk_score").cast("int") * (2**RISK_BITS - 1) / 100)
    decision = F.coalesce(F.array_position(F.array(*map(F.lit, OUTCOMES)), F.col("decision")), F.lit(0))
    key = interleaved((decision, DECISION_BITS), (time, TIME_BITS), (risk, RISK_BITS))
    return rows.withColumn("_key", key).sortWithinPartitions("bucket", "_key", "event_time").drop("_key")


def upsert(
    rows: DataFrame, root: str, staging: str | None = None, is_stored: bool = False, **options: str
) -> None:
    """Brings `rows` into the table; a repeated call with the same `staging` folder only finishes the first one.

    `rows` are read several times: unless `is_stored` says that they can be read cheaply, they are stored before.
    """
    spark = rows.sparkSession
    place = staging or f"{checkpoint_dir(spark)}/upsert-{uuid.uuid4().hex}"
    if not _exists(spark, f"{place}/_SUCCESS"):
        fresh, sizes = _fresh(rows if is_stored else stored(rows))
        if not sizes:
            return
        if not _exists(spark, f"{root}/bucket=*"):
            _overwrite(_laid_out(_merged(fresh, max(sizes.values())), fresh), root, **options)
            return
        old = with_rule_score(spark.read.option("mergeSchema", "true").parquet(root))
        touched = old.where(F.col("bucket").isin(list(sizes)))
        for bucket, n in touched.groupBy("bucket").count().collect():
            sizes[bucket] += n
        both = touched.unionByName(fresh, allowMissingColumns=True)
        _merged(both, max(sizes.values())).write.mode("overwrite").parquet(place)
    staged = spark.read.parquet(place)
    _overwrite(_laid_out(staged, staged), root, **options)


def _overwrite(rows: DataFrame, root: str, **options: str) -> None:
    """Replaces the partitions that `rows` fall into."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        # Serves lookups by transaction, which no sort order of the table helps.
        .option("parquet.bloom.filter.enabled#transaction_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .options(**options)
        .partitionBy("bucket")
        .parquet(root)
    )


def _fresh(source: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """A stored batch as table rows, and how many of them each of its buckets has.

    Ids fall evenly into the parts of a bucket, so a part too large for a task holds an id with very many copies:
    then only the latest decisions of the batch go on, found without bringing the copies together.
    """
    checked = enforce(with_rule_score(source))
    sizes, largest = _sizes(source)
    if largest > ROWS_PER_PIECE:
        checked = stored(latest_decisions(checked))
        sizes, _ = _sizes(checked)
    stamps = {"ingested_at": F.current_timestamp(), "bucket": _bucket(F.col("transaction_id"))}
    return checked.withColumns(stamps), sizes


def _sizes(rows: DataFrame) -> tuple[dict[int, int], int]:
    """Rows per bucket, and those of the largest of `CELLS` parts of a bucket."""
    name = F.col("transaction_id")
    cells = rows.groupBy(_bucket(name).alias("bucket"), _part(name, CELLS).alias("cell")).count()
    found = cells.groupBy("bucket").agg(F.sum("count").alias("n"), F.max("count").alias("largest")).collect()
    return {r.bucket: r.n for r in found}, max((r.largest for r in found), default=0)


def _merged(rows: DataFrame, largest: int) -> DataFrame:
    """The latest decision per id, as `latest_decisions` finds it, of rows whose largest bucket has so many.

    A task gets a part of one bucket, whole ids, and sorts them by hash, which a number tells apart.
    """
    parts = -(-largest // ROWS_PER_PIECE)
    name = F.col("transaction_id")
    dealt = rows.withColumns(
        {"_task": F.col("bucket") * parts + _part(name, parts), "_hash": F.xxhash64(name)}
    ).repartitionById(BUCKETS * parts, "_task")
    newest = Window.partitionBy("_hash", "_task", "transaction_id").orderBy(
        F.desc("processed_at"), F.desc("arrival")
    )
    latest = dealt.withColumn("_row", F.row_number().over(newest)).where("_row = 1")
    return latest.drop("_task", "_hash", "_row")


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The current decision table."""
    if not _exists(spark, root):
        raise FileNotFoundError(f"no decisions under {root}")
    return spark.read.parquet(root).drop("bucket")


def lookup_table(spark: SparkSession, root: str, transaction_id: str) -> DataFrame:
    """The one partition of the table that can hold the transaction."""
    if not _exists(spark, root):
        raise FileNotFoundError(f"no decisions under {root}")
    return spark.read.parquet(root).where(F.col("bucket") == _bucket(F.lit(transaction_id))).drop("bucket")
