"""Ordered computations that keep working when one group holds much of the table.

A window partitioned by entity runs each entity in one task. For groups above a row limit the
functions here cut the group into slices of the order column, compute inside each slice, and carry
the little state a slice needs from its neighbours. The cuts are equi-depth, computed once and then
part of the query as constants, so the slice of a row depends on that row alone: a retried task or a
second read of the same data always agrees. Groups below the limit take the ordinary window.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_TASK = 4_000_000
MAX_SLICES = 10_000
_BASE = 2 * MAX_SLICES + 3  # parts of one level: cuts, and one more cut after each heavy value
SLICE, LARGE = "__slice", "__large"
_KEY, _RANK, _EDGE, _HALO, _AT = "__key", "__rank", "__edge", "__halo", "__at"


def rows_per_task(spark: SparkSession) -> int:
    """Rows one task should sort, from ``spark.tidemark.rowsPerTask`` or the default."""
    return int(spark.conf.get("spark.tidemark.rowsPerTask", str(ROWS_PER_TASK)))


def order_number(df: DataFrame, column: str) -> Column:
    """The column as a number that sorts the same way; strings use a stable hash order."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.StringType):
        return F.xxhash64(c)
    return c


def _sliceable(df: DataFrame, column: str) -> bool:
    """Whether a double orders the column as Spark does."""
    return isinstance(
        df.schema[column].dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)
    )


def equi_depth_cuts(df: DataFrame, column: str, slices: int) -> tuple[list[float], list[float]]:
    """Values that split the column into ``slices`` parts of about equal row counts, and heavy values.

    A value that several cuts fall on holds more than one part; it gets a part of its own, from the
    value up to the next double, and is reported as heavy when that part holds this value only.
    """
    if slices < 2:
        return [], []
    fractions = [i / slices for i in range(1, slices)]
    numbers = df.select(order_number(df, column).cast("double").alias(_KEY))
    accuracy = max(10_000, 10 * slices)
    found = numbers.where(~F.isnan(_KEY)).agg(F.percentile_approx(_KEY, fractions, accuracy)).first()[0] or []
    kind = df.schema[column].dataType
    exact = 0.0 if isinstance(kind, T.DecimalType) else math.inf if isinstance(kind, T.FractionalType) else 2.0**53
    heavy = sorted({v for v, n in Counter(found).items() if n > 1 and abs(v) < exact})
    return sorted({*found, *(math.nextafter(v, math.inf) for v in heavy)}), heavy


def same_row(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


@dataclass(frozen=True)
class Level:
    """Cuts of one order column; only parts that hold a heavy value are cut further by the next level."""

    column: str
    cuts: list[float]
    heavy: list[float]


@dataclass(frozen=True)
class Slices:
    """How the large groups of a table are cut. ``large`` is None when every row is sliced."""

    by: tuple[str, ...]
    large: DataFrame | None
    levels: list[Level]

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the slice number (0 for ordinary groups) and the large-group flag."""
        if self.large is None:
            df = df.withColumn(LARGE, F.lit(True))
        else:
            keys = [f"__large_{i}" for i in range(len(self.by))]
            marks = self.large.toDF(*keys).withColumn(LARGE, F.lit(True))
            match = F.lit(True)
            for b, k in zip(self.by, keys):
                match = match & F.col(b).eqNullSafe(F.col(k))
            # at most MAX_SLICES rows, see `find_slices`
            df = df.join(F.broadcast(marks), match, "left").drop(*keys)
            df = df.withColumn(LARGE, F.coalesce(F.col(LARGE), F.lit(False)))
        columns, number, deeper = df.columns, F.lit(0).cast("long"), F.col(LARGE)
        for i, level in enumerate(self.levels):
            key, part = f"{_KEY}{i}", f"{SLICE}{i}"
            df = df.withColumn(key, order_number(df, level.column).cast("double"))
            if level.cuts:
                edges = [-math.inf, *level.cuts, math.inf]
                df = Bucketizer(splits=edges, inputCol=key, outputCol=part, handleInvalid="keep").transform(df)
                place = F.coalesce(F.col(part).cast("long"), F.lit(-1))
            else:
                place = F.lit(0)
            number = number * _BASE + F.when(deeper, place).otherwise(0)
            deeper = deeper & F.coalesce(F.col(key).isin(level.heavy), F.lit(False))
        return df.withColumn(SLICE, number).select(*columns, SLICE)


def _levels(df: DataFrame, order: Sequence[str], slices: int) -> list[Level]:
    """Cuts of the first order column, then of the next one among the rows of heavy values, and so on."""
    levels: list[Level] = []
    for column in order:
        if column not in df.columns or not _sliceable(df, column):
            break
        cuts, heavy = equi_depth_cuts(df, column, slices)
        levels.append(Level(column, cuts, heavy))
        if not heavy:
            break
        df = df.where(order_number(df, column).cast("double").isin(heavy))
    if not levels:
        raise ValueError(f"order by a number or a time first, not by {order[0]}")
    return levels


def find_slices(
    df: DataFrame, by: Sequence[str], order: Sequence[str], sizing: DataFrame | None = None, at_most: int | None = None
) -> Slices | None:
    """Cuts for the groups that are too large for one task, or None when there are none.

    ``sizing`` is a cheaper table with the same keys to count instead of ``df``, ``at_most`` a known
    bound on its rows that may make counting unnecessary. The limit grows with the table so that at
    most ``MAX_SLICES`` groups can exceed it: the list brought to the driver and broadcast has that
    bound. With no ``by`` columns the whole table is one group and always sliced.
    """
    sizing = df if sizing is None else sizing
    spark = df.sparkSession
    limit = rows_per_task(spark)
    if by and at_most is not None and at_most <= limit:
        return None
    total = sizing.count()
    if not by:
        slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / limit))
        return Slices((), None, _levels(sizing, order, min(slices, MAX_SLICES)))
    if total <= limit:
        return None
    limit = max(limit, math.ceil(total / MAX_SLICES))
    counts = sizing.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"))
    found = counts.where(F.col("__rows") > limit).collect()
    if not found:
        return None
    rows = sum(r["__rows"] for r in found)
    schema = T.StructType([T.StructField(b, sizing.schema[b].dataType) for b in by])
    large = spark.createDataFrame([tuple(r[b] for b in by) for r in found], schema)
    slices = min(MAX_SLICES, math.ceil(rows / limit) + 1)
    inside = sizing.join(F.broadcast(large), same_row(sizing, large, by), "left_semi")
    return Slices(tuple(by), large, _levels(inside, order, slices))


def _near_rows(sliced: DataFrame, by: list[str], order: Sequence[str], count: int, following: bool) -> DataFrame:
    """For each slice of a large group, the ``count`` rows just before (or after) it, and no others.

    Row counts per slice tell how many rows lie between two slices. So the row that is r-th from its slice's edge is
    sent to exactly those slices with at most ``count`` - r rows in between: ``count`` rows per slice in all.
    """
    keys = [*by, SLICE]
    toward = [F.col(c).asc() if following else F.col(c).desc() for c in order]
    columns = [c for c in sliced.columns if c != SLICE]
    large = sliced.where(F.col(LARGE))
    edges = large.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*toward)))
    along = Window.partitionBy(*by).orderBy(F.col(SLICE).desc() if following else F.col(SLICE).asc())
    sizes = large.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.withColumn("__upto", F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    ahead = F.struct(F.col(SLICE).alias("to"), (F.col("__upto") - F.col("__n")).alias("start"))
    sizes = sizes.withColumn(_EDGE, F.collect_list(ahead).over(along.rowsBetween(1, count)))
    reach = F.filter(_EDGE, lambda t: t["start"] - F.col("__upto") < count)
    near = F.transform(reach, lambda t: F.struct(t["to"].alias("to"), (t["start"] - F.col("__upto")).alias("gap")))
    targets = sizes.select(*[F.col(k).alias(f"__to_{k}") for k in keys], near.alias(_EDGE)).where(F.size(_EDGE) > 0)
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__to_{k}"))
    sent = edges.where(F.col(_RANK) <= count).join(targets, match)
    sent = sent.withColumn(_EDGE, F.filter(_EDGE, lambda t: t["gap"] + F.col(_RANK) <= count))
    sent = sent.withColumn(_EDGE, F.explode(_EDGE))
    return sent.select(F.col(f"{_EDGE}.to").alias(SLICE), *columns)


def with_window(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    sizing: DataFrame | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Add window columns whose frames reach at most ``before`` rows back and ``after`` rows ahead.

    ``columns`` gets the window (partitioned and ordered, no frame) and returns the new columns.
    """
    by = list(by)
    slices = find_slices(df, by, order, sizing, at_most)
    if slices is None:
        return df.withColumns(columns(Window.partitionBy(*by).orderBy(*order)))
    sliced = slices.assign(df)
    rows = sliced.withColumn(_HALO, F.lit(False))
    for count, following in ((before, False), (after, True)):
        if count:
            near = _near_rows(sliced, by, order, count, following)
            rows = rows.unionByName(near.withColumn(_HALO, F.lit(True)))
    window = Window.partitionBy(*by, SLICE).orderBy(*order)
    return rows.withColumns(columns(window)).where(~F.col(_HALO)).drop(_HALO, SLICE, LARGE)


_AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min}
_MERGE = {"sum": lambda a, b: F.coalesce(a + b, a, b), "max": F.greatest, "min": F.least}


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    values: dict[str, tuple[str, Column]],
    totals: dict[str, Column] | None = None,
    sizing: DataFrame | None = None,
    at_most: int | None = None,
    raw: dict[str, Column] | None = None,
) -> DataFrame:
    """Add running aggregates from the first row of the group up to the current row.

    ``values`` maps the new column to ("sum" | "max" | "min", expression), ``totals`` maps new columns
    to expressions summed over the whole group. Slices add the combined value of earlier slices,
    found from one row per slice. When ``df`` is an aggregate of ``sizing``, ``raw`` gives the same
    columns as expressions over ``sizing``: the slice values then come from a plain scan instead of
    running the aggregate a second time.
    """
    by, totals = list(by), totals or {}
    slices = find_slices(df, by, order, sizing, at_most)

    def columns(keys: list[str]) -> dict[str, Column]:
        group = Window.partitionBy(*keys)
        upto = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        made = {n: _AGGREGATE[k](e).over(upto) for n, (k, e) in values.items()}
        return {**made, **{n: F.sum(e).over(group) for n, e in totals.items()}}

    if slices is None:
        return df.withColumns(columns(by))
    sliced = slices.assign(df)
    keys = [*by, SLICE]
    ways = {**{n: (_AGGREGATE[k], e) for n, (k, e) in values.items()}, **{n: (F.sum, e) for n, e in totals.items()}}
    pieces = [way(raw[n] if raw else e).alias(n) for n, (way, e) in ways.items()]
    parts = (slices.assign(sizing) if raw else sliced).where(F.col(LARGE)).groupBy(*keys).agg(*pieces)
    group = Window.partitionBy(*by)
    earlier = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        *[F.col(k).alias(f"__c_{k}") for k in keys],
        *[_AGGREGATE[k](n).over(earlier).alias(f"__from_{n}") for n, (k, _) in values.items()],
        *[F.sum(n).over(group).alias(f"__all_{n}") for n in totals],
    )
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__c_{k}"))
    inside = sliced.join(carried, match, "left").withColumns(columns(keys))
    whole = {n: _MERGE[k](F.col(f"__from_{n}"), F.col(n)) for n, (k, _) in values.items()}
    whole.update({n: F.coalesce(F.col(f"__all_{n}"), F.col(n)) for n in totals})
    return inside.withColumns(whole).select(*df.columns, *values, *totals)


def exact_cut(df: DataFrame, order: Sequence[str], position: int) -> list[tuple[str, object]]:
    """The smallest prefix of the order columns that ends at row ``position`` (1-based).

    Selects instead of sorting: each pass keeps the range that must hold the position, narrowed by
    approximate percentiles and settled by exact counts. Only scalars reach the driver. The order
    columns must not be NULL.
    """
    limit = rows_per_task(df.sparkSession)
    cut: list[tuple[str, object]] = []
    rest = df
    for i, column in enumerate(order):
        text = isinstance(rest.schema[column].dataType, T.StringType)
        number = F.col(column) if text else order_number(rest, column)
        column_rest = rest.select(number.alias(_AT), *order[i + 1 :])
        span, total = column_rest, column_rest.count()
        skipped = 0
        if text and total > limit:
            span, total, skipped = _text_range(span, position, total, limit)
        while total > limit and not text:
            low, high = _bracket(span, position - skipped, total)
            inside = span.where(F.col(_AT).between(low, high))
            below, kept = span.agg(F.count_if(F.col(_AT) < low), F.count_if(F.col(_AT).between(low, high))).first()
            if kept == total or not below < position - skipped <= below + kept:
                break  # no narrower range is known; the counts below are exact either way
            span, total, skipped = inside, kept, skipped + below
            if low == high:
                break
        counts = span.groupBy(_AT).agg(F.count(F.lit(1)).alias("__rows"))
        if total <= limit or text:  # one task can sort what is left
            whole = Window.orderBy(_AT).rowsBetween(Window.unboundedPreceding, 0)
            totals = counts.withColumn("__upto", F.sum("__rows").over(whole))
        else:
            totals = running(counts, [], [_AT], {"__upto": ("sum", F.col("__rows"))}, sizing=span)
        row = totals.where(F.col("__upto") >= position - skipped).orderBy(_AT).first()
        cut.append((column, row[_AT]))
        position = position - skipped - (row["__upto"] - row["__rows"])
        if position == row["__rows"]:
            break
        rest = column_rest.where(F.col(_AT) == F.lit(row[_AT]))
    return cut


def _text_range(span: DataFrame, position: int, total: int, limit: int) -> tuple[DataFrame, int, int]:
    """The rows that share the longest prefix known of the text at ``position``: exact counts, one more character at a
    time, until ``limit`` rows or a single text is left. A pass brings one count per character to the driver."""
    skipped, length = 0, 0
    while total > limit:
        length += 1
        head = F.substring(_AT, 1, length)
        for prefix, rows in sorted(span.groupBy(head).agg(F.count(F.lit(1))).collect(), key=lambda r: r[0].encode()):
            if position <= skipped + rows:
                break
            skipped += rows
        span, total = span.where(head == prefix), rows
        if len(prefix) < length:
            break  # the text itself, alone
    return span, total, skipped


def _bracket(span: DataFrame, position: int, total: int) -> tuple[object, object]:
    share = position / total
    probs = [max(0.0, share - 0.002), min(1.0, share + 0.002)]
    return tuple(span.agg(F.percentile_approx(_AT, probs, 10_000)).first()[0])


def up_to_cut(df: DataFrame, cut: list[tuple[str, object]]) -> Column:
    """True for rows at or before the cut: a plain comparison, no shuffle. Columns are compared as they are, with
    constants of their own type, so a filter on one side reaches the scan."""
    result = F.lit(True)
    for column, value in reversed(cut):
        kind, c, limit = df.schema[column].dataType, F.col(column), F.lit(value)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            limit = F.timestamp_micros(limit).cast(kind)
        result = (c < limit) | ((c == limit) & result)
    return result
