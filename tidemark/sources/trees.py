"""Versions of a table as hash trees: parts are stored once by content, a version names its parts under one root."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.versions import diff, part_digests

PART, DIGEST = "__part", "__digest"
MANIFEST = f"{PART} string, {DIGEST} string, n_rows long"


@dataclass(frozen=True)
class Saved:
    """What a save has done: the version's root, its parts, and how many of them had to be written."""

    root: str
    parts: int
    written: int


class TreeStore:
    """Versions of one table under a folder.

    ``objects/__digest=<digest>`` holds the rows of a part, once for all versions that have it; ``versions/__root=<root>``
    holds the parts of a version (``__part``, ``__digest``, ``n_rows``) and is written last, so a version is there when its
    objects are. ``part``, an expression over the row, says how rows are dealt into parts and must stay the same over versions: a day
    for logs that grow, a hash of the key for tables that change. Digests do not depend on the order of rows or on tasks. A version has
    as many manifest rows as parts, and these are all that the driver sees.
    """

    def __init__(self, spark: SparkSession, folder: str, part: Column):
        self.spark, self.part = spark, part.cast("string")
        self.objects, self.versions = f"{folder}/objects", f"{folder}/versions"

    def digests(self, df: DataFrame) -> DataFrame:
        """(__part, __digest, n_rows) of a table: one pass, one row per part and task shuffled."""
        return part_digests(df, F.coalesce(self.part, F.lit("")).alias(PART))

    def _exists(self, path: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def save(self, df: DataFrame) -> Saved:
        """Write the parts that no saved version has, then the version. Saving a version again writes nothing.

        An object that an interrupted save has left is overwritten whole, as no version names it.
        """
        parts = [tuple(r) for r in self.digests(df).collect()]
        root = hashlib.sha256("\n".join(f"{p}={d}" for p, d, _ in sorted(parts)).encode()).hexdigest()
        if self._exists(f"{self.versions}/__root={root}/_SUCCESS"):
            return Saved(root, len(parts), 0)
        manifest = self.spark.createDataFrame(parts, MANIFEST)
        known = None
        if self._exists(self.versions):
            known = self.spark.read.schema(MANIFEST).parquet(self.versions).select(DIGEST).distinct()
        new = manifest if known is None else manifest.join(known, DIGEST, "left_anti")
        missing = sorted((r[PART], r[DIGEST]) for r in new.collect())
        if missing:
            named = self.spark.createDataFrame(missing, f"{PART} string, {DIGEST} string")
            rows = df.withColumn(PART, F.coalesce(self.part, F.lit(""))).join(F.broadcast(named), PART)
            out = rows.drop(PART).write.partitionBy(DIGEST).mode("overwrite")
            out.option("partitionOverwriteMode", "dynamic").parquet(self.objects)
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.versions}/__root={root}")
        return Saved(root, len(parts), len(missing))

    def manifest(self, root: str) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.versions}/__root={root}")

    def _rows(self, parts: DataFrame, empty: DataFrame) -> DataFrame:
        """The rows of some parts. Rows decide their part, so two parts of a version never have the same digest."""
        digests = sorted(r[0] for r in parts.select(DIGEST).collect())
        if not digests:
            return empty
        read = self.spark.read.schema(empty.schema).option("basePath", self.objects)
        return read.parquet(*[f"{self.objects}/{DIGEST}={d}" for d in digests]).select(*empty.columns)

    def _none(self) -> DataFrame:
        """A table without rows and with the columns of the stored ones."""
        return self.spark.read.parquet(self.objects).drop(DIGEST).where("false")

    def restore(self, root: str) -> DataFrame:
        """The table as it was: its objects are read where they lie, nothing is copied."""
        return self._rows(self.manifest(root), self._none())

    def changed_parts(self, old: str, new: str) -> DataFrame:
        """(__part, old, new, n_old, n_new) of the parts that differ, from the manifests alone."""
        sides = [
            self.manifest(root).select(PART, F.col(DIGEST).alias(name), F.col("n_rows").alias(f"n_{name}"))
            for root, name in ((old, "old"), (new, "new"))
        ]
        both = sides[0].join(sides[1], PART, "full_outer")
        return both.where(~F.col("old").eqNullSafe(F.col("new")))

    def diff(self, old: str, new: str) -> DataFrame:
        """Rows added and removed, repeated rows counted; only parts that differ are read."""
        changed, none = self.changed_parts(old, new), self._none()
        rows = [
            self._rows(changed.where(F.col(c).isNotNull()).select(F.col(c).alias(DIGEST)), none) for c in ("old", "new")
        ]
        return diff(*rows)

    def is_current(self, root: str, df: DataFrame) -> bool:
        """Whether a table still is the saved version, so a stage that only depends on it can be skipped."""
        same = self.digests(df).select(PART, DIGEST)
        saved = self.manifest(root).select(PART, DIGEST)
        return same.exceptAll(saved).isEmpty() and saved.exceptAll(same).isEmpty()
