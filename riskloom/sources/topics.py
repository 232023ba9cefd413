"""Message topics as DataFrames with the columns of a Kafka source.

`files` topics are Parquet folders of the same shape, for runs without a broker; there a
message keeps the partition and offset of the message it was made from, so writing the
same batch again gives the same rows.  Where order matters, `append` writes ranges of offsets whose files
a stream meets in order, however many of them a micro-batch takes; it needs a file system that keeps the times
it is told.  The Kafka options are configuration only and need the spark-sql-kafka connector on the classpath.
"""

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from riskloom.session import stored

MESSAGE_COLUMNS = {
    "key": "binary",
    "value": "binary",
    "headers": "array<struct<key: string, value: binary>>",
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "timestamp": "timestamp",
}
MESSAGE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in MESSAGE_COLUMNS.items())
POSITION = ("topic", "partition", "offset", "timestamp")


@dataclass(frozen=True)
class Topics:
    """Where topics live: a folder, or the brokers of a Kafka cluster."""

    root: str | None = None
    brokers: str | None = None
    # Bounds one micro-batch and with it what a single customer can bring into a task.
    files_per_batch: int = 200
    offsets_per_batch: int = 5_000_000
    # Messages in one file, and so what one task of a stream reads at least.
    offsets_per_file: int = 250_000
    options: dict = field(default_factory=dict)

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def _kafka(self, topic: str) -> dict:
        return {
            "kafka.bootstrap.servers": self.brokers,
            "subscribe": topic,
            "startingOffsets": "earliest",
            "includeHeaders": "true",
            **self.options,
        }

    def stream(self, spark: SparkSession, topic: str) -> DataFrame:
        """All messages from the earliest one; the query's checkpoint is the commit."""
        if self.brokers:
            reader = spark.readStream.format("kafka").options(**self._kafka(topic))
            return reader.option("maxOffsetsPerTrigger", self.offsets_per_batch).load()
        # A topic exists before its first message.
        place = spark._jvm.org.apache.hadoop.fs.Path(self.path(topic))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
        reader = spark.readStream.schema(MESSAGE_SCHEMA).option(
            "maxFilesPerTrigger", self.files_per_batch
        )
        return reader.parquet(self.path(topic))

    def table(self, spark: SparkSession, topic: str) -> DataFrame:
        """What the topic holds now."""
        if self.brokers:
            return spark.read.format("kafka").options(**self._kafka(topic)).load()
        return spark.read.schema(MESSAGE_SCHEMA).parquet(self.path(topic))

    def writer(self, messages: DataFrame, topic: str) -> DataStreamWriter:
        """A query, not started yet, that publishes key, value and headers."""
        named = as_messages(messages, topic)
        if self.brokers:
            return (
                named.select("key", "value", "headers")
                .writeStream.format("kafka")
                .option("kafka.bootstrap.servers", self.brokers)
                .option("includeHeaders", "true")
                .option("topic", topic)
            )
        return named.writeStream.format("parquet").option("path", self.path(topic))

    def append(self, messages: DataFrame, topic: str, ordered: bool = False) -> None:
        """Publishes a batch of messages; `ordered` keeps each partition's order by offset."""
        named = as_messages(messages, topic)
        if self.brokers:
            (
                named.select("key", "value", "headers")
                .write.format("kafka")
                .option("kafka.bootstrap.servers", self.brokers)
                .option("includeHeaders", "true")
                .option("topic", topic)
                .save()
            )
            return
        if not ordered:
            named.write.mode("append").parquet(self.path(topic))
            return
        self._append_in_order(named, topic)

    def _append_in_order(self, named: DataFrame, topic: str) -> None:
        """One job writes ranges of offsets, as many as the rows need, to a folder of its own; the files are then
        moved to the topic in the order of their offsets.

        A stream takes files by their time, so each gets one behind the one before; a file holds its offsets of all
        partitions, so whatever prefix of them a micro-batch takes, no partition is ahead of its order.
        """
        spark = named.sparkSession
        rows = stored(named)
        files = -(-rows.count() // self.offsets_per_file)
        if not files:
            return
        folder = f"{self.root}/_appended/{topic}-{uuid.uuid4().hex}"
        ranges = rows.repartitionByRange(files, "offset", "partition").sortWithinPartitions("offset", "partition")
        ranges.write.parquet(folder)
        paths = spark._jvm.org.apache.hadoop.fs.Path
        system = paths(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        target = paths(self.path(topic))
        system.mkdirs(target)
        times = [entry.getModificationTime() for entry in system.listStatus(target) if entry.isFile()]
        clock = max([int(time.time() * 1000), *(t + 1 for t in times)])
        names = sorted(entry.getPath().getName() for entry in system.listStatus(paths(folder)))
        for position, name in enumerate(n for n in names if n.startswith("part-")):
            system.setTimes(paths(f"{folder}/{name}"), clock + position, -1)
            system.rename(paths(f"{folder}/{name}"), paths(f"{self.path(topic)}/{name}"))


def as_messages(messages: DataFrame, topic: str) -> DataFrame:
    """The message columns in order; headers and place default to empty."""
    present = set(messages.columns)
    columns = []
    for name, kind in MESSAGE_COLUMNS.items():
        value = F.col(name) if name in present else F.lit(None)
        columns.append(value.cast(kind).alias(name))
    return messages.select(*columns).withColumn("topic", F.lit(topic))
