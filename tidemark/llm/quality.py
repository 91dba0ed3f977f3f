"""Quality classifier: random Fourier features of document statistics, ridge by summed normal equations, isotonic scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import SPACED, Words, with_text_columns
from tidemark.plans.scratch import written

FOLDS = 5
BINS = 2000


def _table(chars: str) -> np.ndarray:
    made = np.zeros(256, bool)
    made[list(chars.encode())] = True
    return made


KINDS = {
    "upper": _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digit": _table("0123456789"),
    "stop": _table(".,;:?"),
    "shout": _table("!"),
    "bar": _table("|"),
    "sign": _table("#$%&*+<=>@^_~`{}[]\\/"),
    "quote": _table("\"'()-"),
    "line": _table("\n"),
    "blank": ~SPACED,
    "wide": np.arange(256) >= 128,
}
STATISTICS = (
    *KINDS, "log_bytes", "log_words", "word_length", "long_words", "distinct", "top_word", "repeated_next",
    "distinct_pairs", "marked_words", "upper_words", "stop_words_end",
)


def _per_text(flags: np.ndarray, borders: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return (sums[borders[1:]] - sums[borders[:-1]]).astype(float)


def _runs(owner: np.ndarray, hashes: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the most frequent one, per text."""
    keys = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    if not len(keys):
        return np.zeros(texts), np.zeros(texts)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    of = (keys[first] >> np.uint64(48)).astype(np.int64)
    top = np.zeros(texts)
    np.maximum.at(top, of, np.diff(np.append(first, len(keys))).astype(float))
    return np.bincount(of, minlength=texts).astype(float), top


def statistics_of(data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text, all finite; a text without bytes or words has zero shares."""
    texts = len(borders) - 1
    size = np.diff(borders).astype(float)
    share = np.maximum(size, 1)
    kinds = {k: _per_text(t[data], borders) for k, t in KINDS.items()}
    words = Words(data, borders, SPACED)
    count = words.count.astype(float)
    many = np.maximum(count, 1)
    owner = words.owner()
    length = (words.end - words.start).astype(float)
    distinct, top = _runs(owner, words.hash, texts)
    same = np.concatenate(([False], (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])))[: len(owner)]
    pairs = words.hash * np.uint64(3) + np.concatenate((np.zeros(1, np.uint64), words.hash))[: len(owner)]
    pair_kinds, _ = _runs(owner, pairs * np.uint64(0x9E3779B97F4A7C15), texts)
    odd = KINDS["sign"] | KINDS["bar"] | KINDS["shout"]
    last = data[words.end - 1] if len(owner) else np.zeros(0, np.uint8)
    initial = data[words.start] if len(owner) else last
    second = data[np.minimum(words.start + 1, np.maximum(words.end - 1, 0))] if len(owner) else last
    by_text = lambda x: np.bincount(owner, weights=x.astype(float), minlength=texts) / many
    columns = [kinds[k] / share for k in KINDS] + [
        np.log1p(size), np.log1p(count), by_text(length), by_text(length > 20), distinct / many, top / many,
        by_text(same), pair_kinds / many, by_text(odd[last] | odd[initial]),
        by_text(KINDS["upper"][initial] & KINDS["upper"][second]), by_text(KINDS["stop"][last]),
    ]
    return np.stack(columns, axis=1)


def with_statistics(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus ``statistics`` (array of double)."""

    def compute(data, borders):
        rows = statistics_of(data, borders)
        flat = pa.array(rows.ravel())
        return {"statistics": pa.ListArray.from_arrays(
            pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS)), flat)}

    return with_text_columns(docs, text, compute, [T.StructField("statistics", T.ArrayType(T.DoubleType()))], keep)


def fold(id_col: Column, folds: int = FOLDS) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``folds``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


@dataclass
class Model:
    """Everything a task needs to score: about 100 kB."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray
    coefficients: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.weights + self.phase) * np.sqrt(2 / len(self.phase))
        return np.concatenate((waves, np.ones((len(x), 1))), axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.coefficients

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), 0.5)
        return np.interp(self.raw(x), self.knots, self.values)


def _rows(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def _normal_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y, summed inside each partition, then over partitions by Spark."""
    size = len(model.phase) + 1
    row, col = np.triu_indices(size)

    def sums(batches):
        gram, right = np.zeros((size, size)), np.zeros(size)
        seen = False
        for batch in batches:
            if batch.num_rows:
                seen = True
                z = model.features(_rows(batch.column("statistics")))
                gram += z.T @ z
                right += z.T @ batch.column("label").to_numpy(zero_copy_only=False)
        if seen:
            values = np.concatenate((gram[row, col], right))
            at = np.concatenate((row * (size + 1) + col, np.arange(size) * (size + 1) + size))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(values)], names=["at", "value"])

    made = train.select("statistics", "label").mapInArrow(sums, "at bigint, value double")
    gram, right = np.zeros((size, size)), np.zeros(size)
    for at, value in made.groupBy("at").agg(F.sum("value")).collect():
        i, j = divmod(at, size + 1)
        if j == size:
            right[i] = value
        else:
            gram[i, j] = gram[j, i] = value
    return gram, right


def isotonic(place: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the best non-decreasing fit, by pooling adjacent violators; linear between pools."""
    pools: list[list[float]] = []
    for p, w, m in zip(place, weight, mean):
        pools.append([p * w, w, m * w])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    made = np.array(pools).reshape(-1, 3)
    return made[:, 0] / made[:, 1], made[:, 2] / made[:, 1]


def fit(train: DataFrame, waves: int = 192, width: float = 3.0, ridge: float = 1.0, seed: int = 17) -> Model:
    """Fit on all rows of ``train`` (statistics, label 0 or 1).

    Gaussian kernel of ``width`` on standardised statistics. What reaches the driver has a fixed size: the moments of
    the statistics, (waves + 1)**2 / 2 sums, and BINS counts of raw scores.
    """
    n = len(STATISTICS)
    item = lambda i: F.element_at("statistics", i + 1)
    moments = train.agg(
        F.count("*"), *[F.avg(item(i)) for i in range(n)], *[F.stddev_pop(item(i)) for i in range(n)]
    ).first()
    rng = np.random.default_rng(seed)
    weights, phase = rng.normal(size=(n, waves)) / width, rng.uniform(0, 2 * np.pi, waves)
    none = np.zeros(0)
    if not moments[0]:
        return Model(np.zeros(n), np.ones(n), weights, phase, np.zeros(waves + 1), none, none)
    mean = np.array(moments[1 : n + 1], float)
    scale = np.maximum(np.array(moments[n + 1 :], float), 1e-6)
    model = Model(mean, scale, weights, phase, np.zeros(waves + 1), none, none)
    gram, right = _normal_equations(train, model)
    penalty = np.full(waves + 1, ridge)
    penalty[-1] = 1e-6
    model.coefficients = np.round(np.linalg.solve(gram + np.diag(penalty), right), 9)

    def raw(batches):
        for batch in batches:
            if batch.num_rows:
                got = model.raw(_rows(batch.column("statistics")))
                cell = np.clip(np.floor((got + 1) / 3 * BINS), 0, BINS - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), batch.column("label")], names=["cell", "label"])

    cells = train.select("statistics", F.col("label").cast("double")).mapInArrow(raw, "cell bigint, label double")
    counted = sorted(cells.groupBy("cell").agg(F.count("*"), F.avg("label")).collect())
    place = (np.array([r[0] for r in counted]) + 0.5) / BINS * 3 - 1
    model.knots, model.values = isotonic(place, np.array([r[1] for r in counted], float),
                                         np.array([r[2] for r in counted], float))
    return model


def scored(rows: DataFrame, model: Model, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus score in [0, 1] of rows with statistics."""
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                made = model.score(_rows(batch.column("statistics")))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], pa.array(made)], names=schema.fieldNames())

    return rows.select(*keep, "statistics").mapInArrow(run, schema)


def _scores(each: DataFrame, labels: DataFrame, keep: Sequence[str], id_col: str, label: str) -> DataFrame:
    """``keep`` columns of ``each`` (doc_id, __t and others) and the score, by a model fitted on its labelled rows."""
    each = written(with_statistics(each, keep, "__t"), "statistics")
    known = labels.select(F.col(id_col).alias("__id"), F.col(label).cast("double").alias("label"))
    known = known.where(F.col("label").isNotNull() & (fold(F.col("__id")) != 0))
    train = written(each.join(known, each["doc_id"] == known["__id"]).select("statistics", "label"), "train")
    return scored(each, fit(train), keep)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Only rows outside fold 0 lend their labels; scores come from statistics of the whole text alone. Null and empty
    texts have statistics of zero and a score like any other; a null id is never held out and has no label; null labels
    are skipped; repeated labels weigh as often as they stand there. Without any label every score is 0.5.
    """
    each = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("__t"))
    out = _scores(each, labels, ["doc_id"], id_col, label)
    return out.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, each judged by its own text.

    Rows get a key that is written with them, so rows without an id and different texts under one id are told apart.
    """
    names = {c: f"__doc{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    inner = written(inner.withColumn("row", F.monotonically_increasing_id()), "rows")
    each = inner.select("row", F.col(names[id_col]).alias("doc_id"), F.col(names[text]).alias("__t"))
    rejected = _scores(each, labels, ["row", "doc_id"], id_col, label).where(~(F.col("score") >= threshold))
    kept = inner.join(written(rejected.select("row"), "rejected"), "row", "left_anti")
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
