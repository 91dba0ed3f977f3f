"""Structured Streaming forms of the monitoring and cleaning operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import watermarked
from tidemark.operators.drift import dataset_drift, drift_from_profile, reference_counts
from tidemark.plans.scratch import fresh_path
from tidemark.streaming.alerts import alert_stream  # noqa: F401

WATERMARK = "10 minutes"


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream; ``pattern`` selects by file name."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def drop_copies(stream: DataFrame, keys: Sequence[str], time: str = "ts", watermark: str = WATERMARK) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark delay; state is kept no longer than that."""
    kind = stream.schema[time].dataType
    single = watermarked(stream, time, watermark).dropDuplicatesWithinWatermark(list(keys))
    return single.withColumn(time, F.col(time).cast(kind))


TIMERS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _run(stream: DataFrame, path: str, state: str) -> StreamingQuery:
    """Append what is available to a table. State is kept outside the heap, in a store that has timers."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, TIMERS)
    try:
        query = (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", state)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return query
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def run_to_table(stream: DataFrame, name: str, *endings: Ending) -> DataFrame:
    """Process what is available, append it to a table in the shared folder, and return that table.

    The file sink commits each batch once, so a restarted or retried batch leaves no copies. With ``endings`` (through
    which its streams were watermarked) the query goes on from its checkpoint once the ends are marked, and so gives the
    windows and timers that were still open; times come back in the type the log has.
    """
    spark = stream.sparkSession
    path, state = fresh_path(spark, name), fresh_path(spark, f"{name}-state")
    _run(stream, path, state)
    for ending in endings:
        ending.mark()
    if endings:
        _run(stream, path, state)
    made = spark.read.schema(stream.schema).parquet(path)
    times = [f.name for f in made.schema.fields if f.dataType == T.TimestampType()] if endings else []
    return made.withColumns({t: F.col(t).cast(endings[0].schema[endings[0].time].dataType) for t in times})


class Ending:
    """The end of a log as a stream of its own: one late mark that moves the watermark to ``at`` and is not a row."""

    def __init__(self, stream: DataFrame, at: datetime, time: str = "ts", delay: timedelta = timedelta(minutes=10)):
        self.schema, self.at, self.time, self.delay = stream.schema, at, time, delay
        self.folder = fresh_path(stream.sparkSession, "ending")
        self.spark = stream.sparkSession
        self._write([])

    def _write(self, rows: list) -> None:
        marks = self.spark.createDataFrame(rows, "at timestamp_ntz")
        kind = lambda f: (F.col("at") if f.name == self.time else F.lit(None)).cast(f.dataType).alias(f.name)
        marks.select(*map(kind, self.schema.fields)).coalesce(1).write.mode("append").parquet(self.folder)

    def watermarked(self, stream: DataFrame) -> DataFrame:
        """The stream with its watermark, which also follows the mark; rows from the time of the mark on are not part of it."""
        marks = self.spark.readStream.schema(self.schema).parquet(self.folder)
        both = watermarked(stream.unionByName(marks), self.time, f"{int(self.delay.total_seconds())} seconds")
        before = F.col(self.time) < F.lit(str(self.at + self.delay)).cast("timestamp_ntz").cast("timestamp")
        # no filter goes below a column that is not deterministic: the mark reaches the watermark whatever the query drops
        return both.withColumn("__any", F.rand()).where(before & (F.col("__any") >= 0)).drop("__any")

    def mark(self) -> None:
        self._write([(self.at + self.delay,)])


def rows_too_late(query: StreamingQuery) -> int:
    """Rows dropped so far because they came after the watermark."""
    return sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )


def drift_each_batch(
    reference: DataFrame, columns: Sequence[str], path: str
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that compares every batch with the reference and keeps the roll-up.

    The reference is read once, for counts of its distinct values. Each batch writes its own folder, so a batch that
    runs again replaces its own result.
    """
    known = reference_counts(reference, columns, "stream")

    def compare(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rolled = dataset_drift(drift_from_profile(known, batch, columns)).withColumn("batch_id", F.lit(batch_id))
        rolled.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return compare
