"""Time-respecting and hash-stable splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.functions.exprs import hash_bucket, hash_share
from tidemark.plans.joins import join_small
from tidemark.plans.ordered import exact_cut, up_to_cut
from tidemark.plans.selection import GROUP, grouped_cuts, upto_cuts


def _order(contract: Contract) -> list[str]:
    """Time first; entities and ties settle rows of equal time."""
    return [contract.time, *contract.entity, *contract.tie]


def temporal_split(df: DataFrame, test: float, val: float = 0.0, contract: Contract = Contract()) -> DataFrame:
    """Add ``split``: the first rows by time are train, then val, then test.

    Sizes are max(1, floor(n * share)) for test and val (val only when asked for), the rest is train.
    The two border rows are selected exactly, then each row is compared with them: the table itself
    is neither sorted nor shuffled. Rows without a time count nowhere and get no split.
    """
    known = F.col(contract.time).isNotNull()
    split = F.when(~known, F.lit(None).cast("string"))
    for name, inside in _borders(df, test, val, contract):
        split = split.otherwise(name) if inside is None else split.when(inside, name)
    return df.withColumn("split", split)


def temporal_sides(df: DataFrame, test: float, val: float = 0.0, contract: Contract = Contract()) -> dict[str, DataFrame]:
    """The sides of `temporal_split`, each as a plain filter on the order columns that reaches the file scan."""
    sides, before = {}, F.col(contract.time).isNotNull()
    for name, inside in _borders(df, test, val, contract):
        sides[name] = df.where(before if inside is None else before & inside)
        before = before if inside is None else before & ~inside
    return sides


def _borders(df: DataFrame, test: float, val: float, contract: Contract) -> list[tuple[str, Column | None]]:
    """Sides in order, each with the condition that ends it; the last has none."""
    keys = df.where(F.col(contract.time).isNotNull()).select(*_order(contract))
    n = keys.count()
    if n == 0:
        return [("train", None)]
    n_test = max(1, int(n * test))
    n_val = max(1, int(n * val)) if val > 0 else 0
    n_train = max(1, n - n_test - n_val)
    upto = lambda rows: up_to_cut(df, exact_cut(keys, _order(contract), rows))
    sides = [("train", upto(n_train))]
    if n_val and n_train + n_val < n:
        return [*sides, ("val", upto(n_train + n_val)), ("test", None)]
    return [*sides, ("val" if n_val else "test", None)]


def reference_current(df: DataFrame, columns: Sequence[str], contract: Contract = Contract()) -> DataFrame:
    """Add ``side``: the earlier half of the rows by time is reference, the later half current.

    Rows without a time are on neither side and drop out.
    """
    order = _order(contract)
    df = df.where(F.col(contract.time).isNotNull())
    half = df.count() // 2
    reference = up_to_cut(df, exact_cut(df.select(*order), order, half)) if half else F.lit(False)
    marked = df.withColumn("side", F.when(reference, "reference").otherwise("current"))
    return marked.select(*contract.key, *contract.tie, "side", *columns)


def hash_split(df: DataFrame, key: Sequence[str], test: float, seed: int = 42) -> DataFrame:
    """Random split fixed by the key: no shuffle, and a row keeps its side as the table grows.

    With a group key (a production batch) the whole group falls on one side.
    """
    share = hash_share(key, seed)
    return df.withColumn("split", F.when(share < test, "test").otherwise("train"))


def _first_of_each(df: DataFrame, label: str, key: Sequence[str], share: str, take: Column) -> DataFrame:
    """``df`` with ``__chosen``: the first ``take`` (an expression of ``n``) rows of each class by (share, key)."""
    group, order = [label], [share, *key]
    sizes = df.groupBy(F.struct(label).alias(GROUP)).agg(F.count(F.lit(1)).alias("n"), F.first(label).alias(label))
    wanted = sizes.select(GROUP, take.cast("long").alias("k"))
    return upto_cuts(df, group, order, grouped_cuts(df.select(label, *order), group, order, wanted))


def stratified_split(df: DataFrame, label: str, key: Sequence[str], test: float, seed: int = 42) -> DataFrame:
    """Random split with exactly round(n * test) test rows in every stratum of size n.

    The border row of each stratum is selected by counting, then rows are compared with it: the table is neither sorted
    nor shuffled.
    """
    marked = df.withColumn("__share", hash_share(key, seed))
    split = _first_of_each(marked, label, key, "__share", F.round(F.col("n") * F.lit(float(test))))
    return split.withColumn("split", F.when(F.col("__chosen"), "test").otherwise("train")).select(*df.columns, "split")


def kfold(df: DataFrame, key: Sequence[str], folds: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` in 0..folds-1, fixed by the key."""
    return df.withColumn("fold", hash_bucket(key, seed, folds))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight per class: n / (classes * n_class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    totals = counts.agg(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("k"))
    weight = totals.select((F.col("n") / F.col("k")).alias("w")).scalar() / F.col("n_class")
    return counts.select(label, "n_class", weight.alias("weight"))


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows with the weight of their class, for weighted training."""
    return join_small(df, class_weights(df, label).drop("n_class"), [label])


def resample(df: DataFrame, label: str, key: Sequence[str], rows: Mapping, seed: int = 42) -> DataFrame:
    """Each class with exactly the number of rows asked for, as ``copy`` 1, 2, ... of its rows.

    A class of n rows with k asked for gives every row k // n times, and once more the k % n rows with the smallest hash
    of the key; so a smaller k is a subset of a larger one, and a run repeated gives the same rows. Classes that are not
    named drop out. Nothing but counts is shuffled.
    """
    pairs = [F.struct(F.lit(c).cast(df.schema[label].dataType).alias("c"), F.lit(int(k)).alias("k")) for c, k in rows.items()]
    asked = F.coalesce(F.get(F.filter(F.array(*pairs), lambda p: p["c"].eqNullSafe(F.col(label))), F.lit(0))["k"], F.lit(0))
    marked = df.withColumns({"__share": hash_share(key, seed), "__asked": asked}).where("__asked > 0")
    sizes = marked.groupBy(F.struct(label).alias(GROUP)).agg(F.count(F.lit(1)).alias("__rows"))
    chosen = _first_of_each(marked, label, key, "__share", F.pmod(asked, F.col("n")))
    sized = join_small(chosen.withColumn(GROUP, F.struct(label)), sizes, [GROUP])
    copies = F.floor(F.col("__asked") / F.col("__rows")) + F.col("__chosen").cast("int")
    copied = sized.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    return copied.select(*df.columns, "copy")


def balanced(df: DataFrame, label: str, key: Sequence[str], seed: int = 42, over: bool = False) -> DataFrame:
    """Every class with as many rows as the smallest one, or with ``over`` as the largest one."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    size = (max if over else min)(counts.values(), default=0)
    return resample(df, label, key, {c: size for c in counts}, seed)
