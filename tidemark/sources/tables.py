"""Reading sensor logs, image manifests, demand and cycle tables; writing stage outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import ENTITY, LABEL, READINGS, TIME, Contract
from tidemark.plans.ordered import running

# The sensor file layout, image endings, manifest columns, label delay, lake layers.
SENSOR_SCHEMA = T.StructType(
    [T.StructField(ENTITY, T.StringType()), T.StructField(TIME, T.TimestampNTZType())]
    + [T.StructField(c, T.DoubleType()) for c in READINGS]
    + [T.StructField(LABEL, T.IntegerType())]
)
DEMAND_SCHEMA = T.StructType([T.StructField(TIME, T.TimestampNTZType()), T.StructField("demand", T.LongType())])
IMAGE_ENDINGS = ("png", "jpg", "jpeg", "bmp")
MANIFEST_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("image_path", "label", "split")])
LABEL_DELAY = timedelta(hours=1)
LAYERS = ("raw", "interim", "processed")


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at the path (CSV with a header by its ending, else Parquet), None when it is absent."""
    try:
        return _read_csv(spark, path, schema) if path.endswith(".csv") else spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns by the names in the header, whatever their order; others are ignored, missing ones raise.

    Cells that cannot be cast are NULL. Files whose headers differ from the first one's raise when they are read.
    """
    names = spark.read.option("header", True).csv(path).columns
    if missing := [c for c in schema.names if c not in names]:
        raise ValueError(f"{path} lacks the columns {missing}; present: {names}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    rows = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _data(config: Mapping | None) -> Mapping:
    config = config or {}
    inner = config.get("data")
    return inner if isinstance(inner, Mapping) else config


def clean_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN becomes NULL, which aggregates and windows skip."""
    return df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns})


def read_sensors(
    spark: SparkSession,
    config: Mapping | None = None,
    source: str | None = None,
    fallback: str | None = None,
    schema: T.StructType = SENSOR_SCHEMA,
) -> DataFrame:
    """Sensor log from ``source``, else the configured source, else ``fallback``.

    The schema is declared, never inferred. Rows are not sorted here; `write_sorted` does that.
    """
    chosen = source or _data(config).get("source")
    for path in (chosen, fallback):
        found = _read(spark, path, schema) if path else None
        if found is not None:
            floating = [f.name for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
            return clean_numbers(found, floating)
    raise FileNotFoundError(f"no sensor data at {chosen} or {fallback}")


def write_sorted(df: DataFrame, path: str, contract: Contract = Contract()) -> None:
    """Write range-partitioned and sorted by entity and time.

    Ranges follow sampled row counts, so an entity of any size spreads over as many files as it needs.
    """
    order = [*contract.entity, *contract.order]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def path_parts(relative: Column, endings: Sequence[str] | None = IMAGE_ENDINGS) -> dict[str, Column]:
    """Split and label named by the folders of a relative path, and whether the file counts.

    ``split/label/file``: with fewer than three parts the split is unknown, with fewer than two the
    label is too.
    """
    parts = F.split(relative, "/")
    n = F.size(parts)
    wanted = F.lit(True)
    if endings is not None:
        name = F.element_at(parts, -1)
        wanted = (F.instr(name, ".") > 1) & F.lower(F.substring_index(name, ".", -1)).isin(list(endings))
    return {
        "label": F.when(n >= 2, F.try_element_at(parts, F.lit(-2))).otherwise("unknown"),
        "split": F.when(n >= 3, F.try_element_at(parts, F.lit(1))).otherwise("unknown"),
        "wanted": wanted,
    }


def manifest_from_paths(
    df: DataFrame, path: str, relative: Column, endings: Sequence[str] | None = IMAGE_ENDINGS
) -> DataFrame:
    parts = path_parts(relative, endings)
    rows = df.where(parts["wanted"])
    return rows.select(F.col(path).alias("image_path"), parts["label"].alias("label"), parts["split"].alias("split"))


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(image_path, label, split) of all image files under the root; empty when there is no root.

    Only the paths are read: the file contents are pruned from the scan.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST_SCHEMA)
        raise
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    base = system.makeQualified(folder).toUri().getPath().rstrip("/") + "/"
    # the path without scheme and host, then without the resolved root in front
    plain = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    after = F.when(plain.startswith(base), F.expr(f"substring(path, instr(path, '{_quoted(base)}') + {len(base)})"))
    return manifest_from_paths(files.select("path"), "path", F.coalesce(after, plain))


def daily_demand(df: DataFrame, time: str = TIME) -> DataFrame:
    """Rows per calendar day, days without rows included as 0."""
    kind = df.schema[time].dataType
    daily = df.groupBy(F.col(time).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("demand"))
    ends = df.agg(F.min(time).cast("date").alias("first"), F.max(time).cast("date").alias("last"))
    days = ends.where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias("day"))
    filled = days.join(daily, "day", "left")
    return filled.select(F.col("day").cast(kind).alias(time), F.coalesce("demand", F.lit(0)).alias("demand"))


def read_demand(
    spark: SparkSession, config: Mapping | None = None, source: str | None = None, sensors: DataFrame | None = None
) -> DataFrame:
    """The demand file when there is one, else rows per day of the sensor log."""
    chosen = source or _data(config).get("demand_source")
    found = _read(spark, chosen, DEMAND_SCHEMA) if chosen else None
    if found is not None:
        return found
    return daily_demand(sensors if sensors is not None else read_sensors(spark, config))


def write_splits(df: DataFrame, path: str) -> None:
    """One folder per split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def feature_table(
    df: DataFrame, features: Sequence[str], contract: Contract = Contract(), label: str | None = LABEL
) -> DataFrame:
    """Keys, features, and the label when the table has it."""
    labels = [label] if label and label in df.columns else []
    return df.select(*contract.key, *features, *labels)


def write_feature_table(df: DataFrame, path: str, contract: Contract = Contract()) -> None:
    """Partitioned by day, so that time ranges read only their days."""
    df.withColumn("event_date", F.col(contract.time).cast("date")).write.mode("overwrite").partitionBy(
        "event_date"
    ).parquet(path)


def feature_label_split(
    df: DataFrame,
    order: Sequence[str],
    features: Sequence[str],
    label: str,
    time: str = TIME,
    delay: timedelta = LABEL_DELAY,
    entity: str = "entity_id",
) -> tuple[DataFrame, DataFrame]:
    """Cut a flat table into features and labels.

    The entity is the 0-based row number in the given order, counted slice by slice rather than in
    one task. Labels become known ``delay`` after their features.
    """
    numbered = running(df, [], order, {entity: ("sum", F.lit(1))}).withColumn(entity, F.col(entity) - 1)
    labels = numbered.select(entity, label, (F.col(time) + F.lit(delay)).alias(time))
    return numbered.select(entity, *features, time), labels


def align_cycles(df: DataFrame, unit: str, cycle: str, base: datetime) -> DataFrame:
    """Run-to-failure rows on the time axis: unit becomes the entity, a cycle lasts one hour."""
    start = F.lit(base).cast("timestamp_ntz")
    when = start + F.make_dt_interval(F.lit(0), F.col(cycle).cast("int"))
    return df.withColumns({ENTITY: F.col(unit).cast("string"), TIME: when})


def read_cycles(spark: SparkSession, path: str, columns: Sequence[str], base: datetime) -> DataFrame:
    """Blank-separated text without a header; the first two columns are unit number and time cycles."""
    cells = F.split(F.trim("value"), r"\s+")
    numbers = [F.try_element_at(cells, F.lit(i + 1)).try_cast("double").alias(c) for i, c in enumerate(columns)]
    rows = spark.read.text(path).where(F.length(F.trim("value")) > 0).select(*numbers)
    unit, cycle = columns[0], columns[1]
    return align_cycles(rows.withColumns({c: F.col(c).cast("int") for c in (unit, cycle)}), unit, cycle, base)


def layer_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"layer is one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def write_layer(df: DataFrame, root: str, layer: str, name: str) -> str:
    """Raw tables are written once and never replaced; later layers can be rebuilt."""
    path = layer_path(root, layer, name)
    df.write.mode("errorifexists" if layer == "raw" else "overwrite").parquet(path)
    return path
