"""Cleaning and contract checks. A rule list compiles to one aggregate pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import LABEL, READINGS, Contract
from tidemark.functions.times import truncated, watermarked
from tidemark.plans.ordered import with_window

# Physical limits at ingest, limits of one scoring request, items per request.
SENSOR_RANGES = {"temperature": (-50.0, 250.0), "vibration": (0.0, 100.0), "current": (0.0, 200.0)}
REQUEST_RANGES = {"temperature": (-50.0, 500.0), "vibration": (0.0, None), "current": (0.0, None)}
REQUEST_SIZE = (1, 1000)


class DataValidationError(ValueError):
    """A table broke its contract; the message names every broken rule."""


@dataclass(frozen=True)
class Rule:
    """A named row condition: ``broken`` is true for rows that violate it.

    ``max_share`` is the tolerated share of broken rows; ``column`` is the column it is about.
    """

    name: str
    column: str
    broken: Column
    max_share: float = 0.0


def not_null(column: str, max_share: float = 0.0) -> Rule:
    """NaN is missing as NULL is."""
    number = F.col(column).cast("string").try_cast("double")
    return Rule("not_null", column, F.col(column).isNull() | F.coalesce(F.isnan(number), F.lit(False)), max_share)


def in_range(column: str, low: float | None, high: float | None) -> Rule:
    """Inclusive bounds. NaN, and text that is no number, count as missing, not as out of range."""
    x = F.nanvl(F.col(column).try_cast("double"), F.lit(None).cast("double"))
    outside = F.lit(False)
    if low is not None:
        outside = outside | (x < low)
    if high is not None:
        outside = outside | (x > high)
    return Rule("in_range", column, F.coalesce(outside, F.lit(False)))


def in_set(column: str, allowed: Sequence) -> Rule:
    """NULL is not a violation; a value that cannot be compared with the allowed ones is."""
    if all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in allowed):
        number = F.col(column).cast("string").try_cast("double")
        inside = F.coalesce(number.isin([float(v) for v in allowed]), F.lit(False))
    else:
        inside = F.col(column).cast("string").isin([str(v) for v in allowed])
    return Rule("in_set", column, F.col(column).isNotNull() & ~inside)


def positive(column: str) -> Rule:
    return Rule("positive", column, F.coalesce(F.col(column) <= 0, F.lit(False)))


def castable(column: str, kind: str) -> Rule:
    return Rule(f"is_{kind}", column, F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull())


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise DataValidationError(f"missing columns {missing}; present: {df.columns}")


def check(df: DataFrame, rules: Sequence[Rule], min_rows: int = 1) -> DataFrame:
    """One row per rule: rows seen, rows broken, smallest broken value, passed.

    Rules about absent columns fail without being evaluated. All rules share one scan.
    """
    present = [r for r in rules if r.column in df.columns]
    absent = [r for r in rules if r.column not in df.columns]
    counted = [F.count(F.lit(1)).alias("n")]
    for i, r in enumerate(present):
        counted.append(F.count_if(r.broken).alias(f"b{i}"))
        counted.append(F.min(F.when(r.broken, F.col(r.column).cast("string"))).alias(f"e{i}"))

    def line(rule: str, column: str, broken: Column, example: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(column).alias("column"),
            F.col("n").alias("n_rows"),
            broken.cast("long").alias("n_broken"),
            example.cast("string").alias("example"),
            passed.alias("passed"),
        )

    nothing = F.lit(None)
    lines = [line("non_empty", "*", F.greatest(F.lit(min_rows) - F.col("n"), F.lit(0)), nothing, F.col("n") >= min_rows)]
    for i, r in enumerate(present):
        share = F.coalesce(F.try_divide(F.col(f"b{i}"), F.col("n")), F.lit(0.0))
        lines.append(line(r.name, r.column, F.col(f"b{i}"), F.col(f"e{i}"), share <= r.max_share))
    lines += [line("exists", r.column, F.col("n"), nothing, F.lit(False)) for r in absent]
    return df.agg(*counted).select(F.inline(F.array(*lines)))


def validate(df: DataFrame, rules: Sequence[Rule], min_rows: int = 1) -> DataFrame:
    """Return ``df`` unchanged, or raise naming the broken rules."""
    failed = check(df, rules, min_rows).where(~F.col("passed")).collect()
    if failed:
        said = [f"{r['rule']}({r['column']}): {r['n_broken']} rows, e.g. {r['example']}" for r in failed]
        raise DataValidationError("; ".join(said))
    return df


def sensor_rules(
    contract: Contract = Contract(),
    ranges: Mapping[str, tuple[float, float]] | None = None,
    features: Sequence[str] = READINGS,
    label: str | None = LABEL,
    allow_nulls: bool = False,
) -> list[Rule]:
    """The ingest contract: keys and readings present, readings in range, label 0/1."""
    limits = {**SENSOR_RANGES, **(ranges or {})}
    rules = [] if allow_nulls else [not_null(c) for c in (*contract.key, *features)]
    rules += [in_range(c, *limits[c]) for c in features if c in limits]
    return rules + ([in_set(label, [0, 1])] if label else [])


def validate_sensors(df: DataFrame, contract: Contract = Contract(), **options) -> DataFrame:
    features = options.get("features", READINGS)
    require_columns(df, [*contract.key, *features])
    rules = sensor_rules(contract, **options)
    return validate(df, [r for r in rules if r.column in df.columns])


def validate_manifest(df: DataFrame, allow_empty: bool = True) -> DataFrame:
    require_columns(df, ["image_path", "label", "split"])
    if not allow_empty and df.isEmpty():
        raise DataValidationError("the manifest is empty")
    return df


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reasons``: the rules each row breaks, as "rule:column"."""
    named = [F.when(r.broken, F.lit(f"{r.name}:{r.column}")) for r in rules]
    return df.withColumn("reasons", F.array_compact(F.array(*named)))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reasons)."""
    judged = with_reasons(df, rules)
    good = judged.where(F.size("reasons") == 0).drop("reasons")
    return good, judged.where(F.size("reasons") > 0)


def request_rules(entity: str = "machine_id", ranges: Mapping | None = None) -> list[Rule]:
    """What one reading of a scoring request must satisfy; the time is optional."""
    limits = REQUEST_RANGES if ranges is None else ranges
    rules = [not_null(entity), *[not_null(c) for c in limits]]
    return rules + [in_range(c, lo, hi) for c, (lo, hi) in limits.items()]


def batch_sizes(df: DataFrame, request: Sequence[str], size: tuple[int, int] = REQUEST_SIZE) -> DataFrame:
    """Items per request and whether the number is allowed."""
    counts = df.groupBy(*request).agg(F.count(F.lit(1)).alias("n_items"))
    return counts.withColumn("accepted", F.col("n_items").between(*size))


def dedup_first(df: DataFrame, contract: Contract) -> DataFrame:
    """Keep the first row per entity and time.

    "First" needs a total order: the tie columns, or else all other columns. The rank filter also
    runs before the shuffle, so copies of one key collapse where they are read.
    """
    rest = [f.name for f in df.schema.fields if f.name not in contract.key and not isinstance(f.dataType, T.MapType)]
    order = contract.tie or rest or contract.key
    window = Window.partitionBy(*contract.key).orderBy(*order)
    return df.withColumn("__row", F.row_number().over(window)).where(F.col("__row") == 1).drop("__row")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows and missing values."""
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    lines = [
        F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(c).alias("n_null")) for c in columns
    ]
    return wide.select(F.inline(F.array(*lines)))


def unexpected_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Values outside the domain with their counts; NULL is ignored."""
    outside = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def label_rate(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of positives (of every group); degenerate when there is only one class."""
    rate = df.groupBy(*by).agg(F.count(label).alias("n_rows"), F.avg(label).alias("rate"))
    mixed = (F.col("rate") > 0) & (F.col("rate") < 1)
    return rate.withColumn("degenerate", ~F.coalesce(mixed, F.lit(False)))


def backward_steps(df: DataFrame, arrival: Sequence[str], contract: Contract = Contract()) -> DataFrame:
    """Per entity, how many rows arrived with an earlier time than the row before them."""
    previous = with_window(
        df.select(*contract.entity, contract.time, *arrival),
        contract.entity,
        arrival,
        lambda w: {"__back": (F.col(contract.time) < F.lag(contract.time).over(w)).cast("int")},
        before=1,
    )
    counts = previous.groupBy(*contract.entity).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("__back"), F.lit(0)).cast("long").alias("n_backward")
    )
    return counts.withColumn("monotonic", F.col("n_backward") == 0)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def densify_hourly(df: DataFrame, value: str, contract: Contract = Contract()) -> DataFrame:
    """One row per entity and hour between its first and last reading; hours without data are flagged.

    The hourly table is small per entity (one row per hour), so the gap before the next hour present
    is found with ``lead`` and filled by ``sequence``; no grid is joined.
    """
    hour = truncated(df, contract.time, "hour")
    hourly = df.groupBy(*contract.entity, hour.alias("hour")).agg(F.avg(value).alias("mean_value"))
    following = F.lead("hour").over(Window.partitionBy(*contract.entity).orderBy("hour"))
    step = F.expr("interval 1 hour")
    last = F.coalesce(following - step, F.col("hour"))
    filled = hourly.withColumn("__slots", F.sequence("hour", last, step)).select(
        *contract.entity, F.col("hour").alias("__from"), "mean_value", F.explode("__slots").alias("hour")
    )
    missing = F.col("hour") != F.col("__from")
    return filled.select(
        *contract.entity, "hour", F.when(~missing, F.col("mean_value")).alias("mean_value"), missing.alias("missing")
    )


def downsample(
    df: DataFrame, value: str, width: str = "1 hour", contract: Contract = Contract(), watermark: str | None = None
) -> DataFrame:
    """Per entity and time bucket: count, mean, min, max and last reading (ties decide equal times). Works on streams too."""
    kind = df.schema[contract.time].dataType
    if watermark:
        df = watermarked(df, contract.time, watermark)
    grouped = df.groupBy(*contract.entity, F.window(contract.time, width).alias("__w")).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.max_by(value, F.struct(*contract.order)).alias("last_value"),
    )
    measures = ["n", "mean_value", "min_value", "max_value", "last_value"]
    return grouped.select(*contract.entity, F.col("__w.start").cast(kind).alias("bucket"), *measures)


def drop_outliers(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows whose readings all lie inside the physical limits."""
    for column, (low, high) in ranges.items():
        df = df.where(F.col(column).between(low, high))
    return df


def feature_roles(df: DataFrame, label: str, keys: Sequence[str]) -> list[str]:
    """Numeric columns that are neither the label nor a key."""
    numeric = (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, numeric) and f.name not in (label, *keys)]


def last_column_label(df: DataFrame) -> tuple[list[str], str]:
    """(features, label) for tables whose label is the last column."""
    return df.columns[:-1], df.columns[-1]
