"""Table versions: content fingerprints, differences, snapshots that can be restored."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cell(df: DataFrame, column: str) -> Column:
    """A value as text that does not depend on the session: times as microseconds since 1970."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(kind, T.TimestampNTZType):
        since = F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{column}`)")
        return since.cast("string")
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c, {"timeZone": "UTC"})
    return c.cast("string")


def _row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """128-bit hash of the row; every cell is written after its length, so no two rows read the same."""
    cells = [
        F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~"))
        for t in (_cell(df, c) for c in columns)
    ]
    return F.md5(F.concat(*cells))


def _sums(df: DataFrame, columns: Sequence[str]) -> tuple[list[Column], Column]:
    """Sums of row hashes that tasks combine, and the digest of (n_rows, s0, s1)."""
    digest = _row_hash(df, columns)
    kinds = ",".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)
    schema = hashlib.md5(kinds.encode()).hexdigest()[:8]
    parts = [F.conv(F.substring(digest, at, 12), 16, 10).cast("decimal(38,0)") for at in (1, 13)]
    sums = [F.count(F.lit(1)).alias("n_rows"), *[F.sum(p).alias(f"s{i}") for i, p in enumerate(parts)]]
    pieces = [F.coalesce(F.col(f"s{i}"), F.lit(0)).cast("string") for i in (0, 1)]
    return sums, F.concat_ws("-", F.lit(schema), F.col("n_rows").cast("string"), *pieces)


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (n_rows, version) that depends on names, types and content and not on the order of the rows.

    Row hashes are added up, so tasks combine their parts and a repeated row still changes the sum.
    """
    sums, version = _sums(df, sorted(columns or df.columns))
    return df.agg(*sums).select("n_rows", version.alias("version"))


def part_digests(df: DataFrame, part: Column) -> DataFrame:
    """(part, __digest, n_rows) for the parts of a table, each by its `fingerprint`."""
    sums, version = _sums(df, sorted(df.columns))
    name = df.select(part).columns[0]
    return df.groupBy(part).agg(*sums).select(name, version.alias("__digest"), "n_rows")


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows added and removed between two versions, repeated rows counted."""
    columns, counted = old.columns, _counted(old, new)
    more = F.col("__new") - F.col("__old")
    kind = F.when(more > 0, "added").otherwise("removed")
    rows = counted.where(more != 0).withColumns({"change": kind, "__times": F.abs(more)})
    return _repeated(rows, [*columns, "change"])


def unchanged(old: DataFrame, new: DataFrame) -> DataFrame:
    rows = _counted(old, new).withColumn("__times", F.least("__old", "__new")).where("__times > 0")
    return _repeated(rows, old.columns)


def _counted(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every distinct row with how often each version has it: one scan of each and one shuffle."""
    sides = [d.select(*old.columns, F.lit(a).alias("__old"), F.lit(b).alias("__new")) for d, a, b in ((old, 1, 0), (new, 0, 1))]
    both = sides[0].unionByName(sides[1])
    return both.groupBy(*old.columns).agg(F.sum("__old").alias("__old"), F.sum("__new").alias("__new"))


def _repeated(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.select(*columns, F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*columns)


def save_version(df: DataFrame, root: str) -> str:
    """Write a snapshot named by its content; the same content is written once."""
    version = fingerprint(df).first()["version"]
    path = f"{root}/version={version}"
    df.write.mode("ignore").parquet(path)
    return version


def load_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{root}/version={version}")
