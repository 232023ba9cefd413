"""Session helpers: one place for the clock zone and the checkpoint folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "riskloom", cores: str = "8", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """Session settings that the jobs rely on.

    Event times are instants; every minute floor and text form is defined in UTC.  The
    JVM does not compile methods above 8000 bytes, so wide stages, such as the contract
    checks, run several times faster when their code is split instead of fused.  Parquet
    keeps statistics for instants in microseconds, which filters by time need, and none for
    the older form that Spark writes unless told.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; one is made up only on a local master."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="riskloom-checkpoint-"))
    return context.getCheckpointDir()


def stored(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Computes `df` once, into a table in the checkpoint folder, and reads it from there.

    With `by`, rows are kept in one folder per value of those columns, so a filter on them reads no other.

    Like a checkpoint it cuts the lineage and survives lost executors; unlike one it runs
    the last stage once instead of twice, and later reads take only the columns they need.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
