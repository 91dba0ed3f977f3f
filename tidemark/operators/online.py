"""The online table kept up to date: each step reads new rows only and rewrites the parts they touch."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import Contract
from tidemark.operators.store import latest_rows
from tidemark.plans.scratch import written

PART = "__part"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


class OnlineTable:
    """The latest row per entity under a folder, as a table of ``parts`` directories with ``buckets`` files each.

    Rows lie in parts by a hash of the entity and, inside, in buckets by Spark's own hash, so a step joins the new rows
    to the parts they touch without moving the old ones: only new rows are shuffled (``buckets`` must be as many as the
    session shuffles into, its default here, else Spark prefers to shuffle both). The high-water mark is written
    after the parts. A step that was lost on the way is taken again from the old mark and gives the same rows, since the
    later row of an entity wins and an equal one replaces itself. Rows without an entity cannot be looked up and stay
    out.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: T.StructType,
        features: Sequence[str],
        contract: Contract = Contract(),
        parts: int = 16,
        buckets: int | None = None,
    ):
        self.spark, self.folder, self.contract, self.features, self.parts = spark, folder, contract, list(features), parts
        self.columns = [*contract.entity, contract.time, *features]
        self.name = "online_" + re.sub(r"\W", "_", folder.rsplit("/", 1)[-1])
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        fields = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in self.columns)
        keys = ", ".join(f"`{c}`" for c in contract.entity)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({fields}, {PART} int) USING parquet PARTITIONED BY ({PART}) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{folder}/rows'"
        )
        if self._exists("rows"):
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def _exists(self, inner: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{inner}")
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def mark(self) -> datetime | None:
        """The time up to which the log has been applied."""
        if not self._exists("marks"):
            return None
        return self.spark.read.parquet(f"{self.folder}/marks").agg(F.max("upto")).first()[0]

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.columns)

    def merged(self, new: DataFrame, touched: Sequence[int]) -> DataFrame:
        """The touched parts after the new rows (one per entity, with their part)."""
        entity, time = list(self.contract.entity), self.contract.time
        values = [time, *self.features]
        old = self.spark.table(self.name).where(F.col(PART).isin(list(touched)))
        old = old.select(*entity, F.struct(*values).alias("__old"), F.col(PART).alias("__part_old"))
        both = new.select(*entity, F.struct(*values).alias("__new"), F.col(PART).alias("__part_new"))
        both = both.join(old, entity, "full_outer")
        newer = F.col("__new").isNotNull() & F.coalesce(F.col(f"__new.{time}") >= F.col(f"__old.{time}"), F.lit(True))
        row = F.when(newer, F.col("__new")).otherwise(F.col("__old"))
        both = both.select(*entity, row.alias("__row"), F.coalesce("__part_new", "__part_old").alias(PART))
        return both.select(*entity, "__row.*", PART)

    def step(
        self, log: DataFrame, end: datetime, start: datetime | None = None, lookback: timedelta = timedelta(0)
    ) -> int:
        """Apply the log after the mark up to ``end``; the number of parts rewritten.

        ``start`` bounds the first step. ``lookback`` reads that much before the mark again, for rows that came late.
        """
        kind = log.schema[self.contract.time].dataType
        mark, time = self.mark(), F.col(self.contract.time)
        if mark is not None:
            log = log.where(time > F.lit(mark - lookback).cast(kind))
            start = None
        entity = list(self.contract.entity)
        log = log.dropna("any", subset=entity)
        new = latest_rows(log, self.features, self.contract, start, end)
        new = written(new.withColumn(PART, F.pmod(F.xxhash64(*entity), F.lit(self.parts)).cast("int")), "new-rows")
        touched = [r[0] for r in new.select(PART).distinct().collect()]
        if touched:
            before = self.spark.conf.get(OVERWRITE, None)
            self.spark.conf.set(OVERWRITE, "dynamic")
            try:
                self.merged(new, touched).write.insertInto(self.name, overwrite=True)
            finally:
                self.spark.conf.set(OVERWRITE, before) if before else self.spark.conf.unset(OVERWRITE)
        marks = self.spark.createDataFrame([(end,)], "upto timestamp_ntz")
        marks.coalesce(1).write.mode("append").parquet(f"{self.folder}/marks")
        return len(touched)
