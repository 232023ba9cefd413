"""Durations of running streams: a listener writes every progress record to a table.

A query itself remembers only its last records.  The listener is told of each micro-batch of every query of the session
and writes one row under the query's run and the batch's number, so a record that is told twice replaces itself.
"""

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

RECORD = "query string, run string, batch long, started string, events long, batch_ms long, stages map<string, bigint>"


class ProgressTable(StreamingQueryListener):
    """Records the micro-batches that had input in `folder`."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder
        self._over = threading.Condition()
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        row = (str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.batchDuration, dict(p.durationMs))
        place = f"{self._folder}/run={p.runId}/batch={p.batchId:010d}"
        self._spark.createDataFrame([row], RECORD).coalesce(1).write.mode("overwrite").parquet(place)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._over:
            self._ended.add(str(event.runId))
            self._over.notify_all()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Records come later than the batches; true when all of a query that has ended are written."""
        with self._over:
            return self._over.wait_for(lambda: str(query.runId) in self._ended, seconds)


def record_progress(spark: SparkSession, folder: str) -> ProgressTable:
    """A listener that is at work; `spark.streams.removeListener` ends it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    listener = ProgressTable(spark, folder)
    spark.streams.addListener(listener)
    return listener


def batch_durations(spark: SparkSession, folder: str) -> DataFrame:
    """Per micro-batch: its events, and seconds in all and per event."""
    # Run and batch are in the rows, too; the folders only keep records apart.
    noted = spark.read.schema(RECORD).option("recursiveFileLookup", "true").parquet(folder)
    seconds = F.col("batch_ms") / 1000
    return noted.select("query", "run", "batch", "events", seconds.alias("seconds"), (seconds / F.col("events")).alias("per_event"))
