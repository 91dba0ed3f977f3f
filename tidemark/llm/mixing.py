"""Mixing sources to target weights by systematic sampling (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import written

#: what counts as a word
WORD = r"[^\x20\x09-\x0D]+"
ROW_BITS = 33


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: int) -> Column:
    """One number in [0, 1) for a source and a seed, the same on every run."""
    head = F.substring(F.md5(F.concat(F.coalesce(source, F.lit("")), F.lit(f"|{seed}"))), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sized: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Per source: source_size, target, copies expected of each document, offset.

    Weights go to sources by code point, null last, and repeat. A source whose share is above ``most`` times
    its size stops there and the excess goes to the others by weight: in order of capacity per weight the
    stopped sources are a prefix, so running sums settle it in one step. One row per source is ordered here,
    never one per document.
    """
    each = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    each = each.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)) + 1))
    each = each.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_room = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    each = each.withColumns({
        "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)),
        "still": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0)),
    })
    each = each.withColumn("level", F.col("left") / F.col("still"))
    free = F.col("cap") >= F.col("w") * F.col("level")
    each = each.withColumn("level", F.min(F.when(free, F.struct(F.col("cap") / F.col("w"), "level"))).over(everything))
    each = each.withColumn("target", F.least("cap", F.coalesce(F.col("w") * F.col("level.level"), F.col("cap"))))
    copies = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size")))
    return each.select(
        "source", "source_size", "target", F.coalesce(copies, F.lit(0.0)).alias("copies"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    most: float = 3.0,
    seed: int = 7,
    keep: Sequence[str] = (),
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Every document with the number of times the mix takes it.

    Returns ``keep`` columns plus doc_id, source, size (words), source_size, target, times and taken
    (size * times). Documents of a source are put in order of size, then id; each expects target /
    source_size copies; with one offset per source a document is taken once for every whole number its step
    of the running sum crosses. In order of size the words taken miss the target by a document or so.

    The order is one range sort over (source, size, id), cut where the rows are, so that a source with a third of
    all rows spreads over a third of the tasks. Running sums continue from part to part by a table with one
    row per part and source. Null text has size 0; null sources are one source; rows equal in source, size
    and id follow each other in any order, with the same total; an empty table gives an empty result. Kept
    columns of the same name as a result column give way to it.
    """
    made = ("doc_id", "source", "size", "source_size", "target", "times", "taken")
    keep = [c for c in keep if c not in made]
    sized = docs.select(
        *keep, F.col(id_col).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")
    )
    # kept columns wait aside: in order of size they would pile up where the long texts are
    sized = written(sized.withColumn("__row", F.monotonically_increasing_id()), "sized")
    aside = sized.select("__row", *keep)
    sized = sized.select("__row", "doc_id", "source", "size")
    order = ["source", "size", "doc_id"]
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = sized.repartitionByRange(shuffles, *order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("__at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("__part", F.shiftright("__at", ROW_BITS))
    parts = placed.groupBy("__part", "source").agg(F.count("*").alias("__rows"), F.min("__at").alias("__first"))
    before = Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    wanted = targets(placed, weights, most)
    parts = parts.join(wanted, parts["source"].eqNullSafe(wanted["source"])).select(
        "__part", parts["source"].alias("__source"), "__first", "__before", "source_size", "target", "copies"
    )
    parts = written(parts.withColumn("__offset", offset(F.col("__source"), seed)), "parts")
    same = (placed["__part"] == parts["__part"]) & placed["source"].eqNullSafe(parts["__source"])
    rows = placed.join(parts, same)
    rank = F.col("__at") - F.col("__first") + F.col("__before")
    upto = lambda k: F.floor(k * F.col("copies") + F.col("__offset"))
    rows = rows.withColumn("times", (upto(rank + 1) - upto(rank)).cast("long"))
    rows = rows.select(
        "__row", "doc_id", "source", "size", "source_size", "target", "times",
        (F.col("size") * F.col("times")).alias("taken"),
    )
    return (rows.join(aside, "__row") if keep else rows).drop("__row")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each repeated as often as it is taken; the columns of ``docs``."""
    names = {c: f"__doc{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    rows = mix(
        inner, keep=list(names.values()), id_col=names["doc_id"], text=names["text"], source=names["source"], **options
    )
    rows = rows.where("times > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return rows.select(*[F.col(n).alias(c) for c, n in names.items()])
