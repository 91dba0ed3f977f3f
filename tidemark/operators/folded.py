"""Cross validation of two-class logistic settings: all settings and folds share the passes over the rows.

A search of k settings over f folds fits k * f models, each with many passes. Here the rows are written once in blocks of
one fold and class. A pass adds up loss, gradient and Hessian of every open model at once, so that the fits together
need a few passes; the sums have a fixed size and Newton's method does the rest on the driver. The areas under the ROC
curve are exact: scores are dealt by ranges and pairs are counted.

The models are those of ``logistic_classifier``: means for missing readings and scales come from the training folds,
the objective is that of Spark's multinomial regression with two classes. By symmetry the difference w of its two
coefficient vectors minimises mean log loss + regParam * ((1 - elasticNetParam) / 4 * |w|^2 + elasticNetParam * |w|_1).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.scratch import fresh_path

#: bytes of a block, rows and cells worked on at once (the loss multiplies as many numbers of at most 2 as there are
#: rows), scores sorted in one group
BLOCK_BYTES, STEP_ROWS, STEP_CELLS, RANGE_ROWS = 1 << 18, 512, 1 << 16, 1 << 20
#: scores are shuffled in rounds of so many settings, or more while they have so few bytes; rows that place range borders
ROUND_SETTINGS, ROUND_BYTES, BORDER_ROWS = 4, 1 << 28, 1 << 16
#: most columns of a design (a Hessian has the square); least maxIter: below it Spark's L-BFGS may stop before the optimum
WIDEST, LEAST_ITERATIONS = 24, 50
#: Newton steps after which folds part from the common start, and after which a model is done (its error is the square)
NEAR, DONE = 1e-3, 1e-5


@dataclass(frozen=True)
class Penalty:
    smooth: float
    sharp: float
    rounds: int

    def of(self, theta: np.ndarray) -> float:
        return self.smooth / 2 * float(theta[1:] @ theta[1:]) + self.sharp * float(np.abs(theta[1:]).sum())


def penalties(pipeline: Pipeline, settings: Sequence[Mapping], label: str) -> list[Penalty] | None:
    """The penalty of every setting if the pipeline is that of ``logistic_classifier``, else None."""
    stages = pipeline.getStages()
    if [type(s) for s in stages] != [Imputer, VectorAssembler, StandardScaler, LogisticRegression]:
        return None
    fill, assemble, scale, fit = stages
    plain = (
        fill.isSet("inputCols") and fill.getStrategy() == "mean" and math.isnan(fill.getMissingValue())
        and list(assemble.getInputCols()) == list(fill.getOutputCols())
        and scale.getInputCol() == assemble.getOutputCol() and scale.getWithMean() and scale.getWithStd()
        and fit.getFeaturesCol() == scale.getOutputCol() and fit.getLabelCol() == label
        and fit.getFamily() == "multinomial" and fit.getFitIntercept() and fit.getStandardization()
    )
    odd = ["weightCol", "lowerBoundsOnCoefficients", "upperBoundsOnCoefficients", "lowerBoundsOnIntercepts", "upperBoundsOnIntercepts"]
    if not plain or any(fit.isSet(p) for p in odd) or any(set(s) - {"regParam", "elasticNetParam", "maxIter"} for s in settings):
        return None
    made = []
    for s in settings:
        one = fit.copy({fit.getParam(k): v for k, v in s.items()})
        if one.getMaxIter() < LEAST_ITERATIONS:
            return None
        reg, mix = one.getRegParam(), one.getElasticNetParam()
        made.append(Penalty(reg * (1 - mix) / 2, reg * mix, one.getMaxIter()))
    return made


# Blocks: rows of one fold and class as columns of doubles.


def _pack(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    rows = max(1, BLOCK_BYTES // (8 * width))

    def block(fold: int, label: float, x: np.ndarray) -> dict:
        there = ~np.isnan(x)
        known = there.sum(axis=1)
        with np.errstate(invalid="ignore"):
            mean = np.where(there, x, 0.0).sum(axis=1) / np.maximum(known, 1)
            low, high = np.where(there, x, np.inf).min(axis=1), np.where(there, x, -np.inf).max(axis=1)
            mean = np.where(low == high, low, mean)
            m2 = (np.where(there, x - mean[:, None], 0.0) ** 2).sum(axis=1)
        return {"fold": fold, "label": label, "n": x.shape[1], "known": known.tolist(), "mean": mean.tolist(),
                "m2": m2.tolist(), "x": x.tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[int, float], list[np.ndarray]] = {}
        sizes: dict[tuple[int, float], int] = {}
        for batch in batches:
            fold, label, *x = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            x = np.array(x, dtype=np.float64).reshape(width, len(fold))
            order = np.lexsort((label, fold))
            fold, label, x = fold[order], label[order], x[:, order]
            cuts = np.flatnonzero((np.diff(fold) != 0) | (np.diff(label) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(fold)]):
                if lo == hi:
                    continue
                key = int(fold[lo]), float(label[lo])
                held = waiting.setdefault(key, [])
                held.append(x[:, lo:hi].copy())  # not the whole batch
                sizes[key] = sizes.get(key, 0) + hi - lo
                if sizes[key] >= rows:
                    whole = np.concatenate(held, axis=1)
                    full = whole.shape[1] // rows * rows
                    for at in range(0, full, rows):
                        yield pa.RecordBatch.from_pylist([block(*key, np.ascontiguousarray(whole[:, at : at + rows]))], schema=_SCHEMA)
                    sizes[key] -= full
                    waiting[key] = [whole[:, full:].copy()] if sizes[key] else []
        for key, held in waiting.items():
            if held:
                yield pa.RecordBatch.from_pylist([block(*key, np.concatenate(held, axis=1))], schema=_SCHEMA)

    return run


_SCHEMA = pa.schema([("fold", pa.int32()), ("label", pa.float64()), ("n", pa.int64()), ("known", pa.list_(pa.int64())),
                     ("mean", pa.list_(pa.float64())), ("m2", pa.list_(pa.float64())), ("x", pa.binary())])
_BLOCK = "fold int, label double, n bigint, known array<bigint>, mean array<double>, m2 array<double>, x binary"


def blocks(df: DataFrame, features: Sequence[str], label: str, folds: int, fold_column: str) -> DataFrame:
    """The rows written in blocks. Folds out of range and labels other than 0 and 1 become -1, NULL too."""
    fold, kind = F.col(fold_column), F.col(label).cast("double")
    rows = df.select(
        F.when((fold >= 0) & (fold < folds), fold.cast("int")).otherwise(-1).alias("fold"),
        F.when(kind.isin(0.0, 1.0), kind).otherwise(-1.0).alias("label"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(math.nan)).alias(f"x{i}") for i, c in enumerate(features)],
    )
    path = fresh_path(df.sparkSession, "blocks")
    rows.mapInArrow(_pack(len(features)), _BLOCK).write.option("parquet.block.size", 64 * BLOCK_BYTES).parquet(path)
    return df.sparkSession.read.schema(_BLOCK).parquet(path)


@dataclass(frozen=True)
class Moments:
    """Per fold: rows and rows of class 1; per fold and column: known readings, their mean and squared deviations."""

    n: np.ndarray
    ones: np.ndarray
    known: np.ndarray
    mean: np.ndarray
    m2: np.ndarray

    def of(self, folds: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Means of the known readings, and deviations once the mean stands for each missing one; 0 for a constant."""
        k, folds = self.known[folds], list(folds)
        total = k.sum(axis=0)
        mean = (k * self.mean[folds]).sum(axis=0) / total
        m2 = (self.m2[folds] + k * (self.mean[folds] - mean) ** 2).sum(axis=0)
        std = np.sqrt(m2 / max(1, self.n[folds].sum() - 1))
        return mean, np.where(std > 1e-15 * np.abs(mean), std, 0.0)


def moments(packed: DataFrame, folds: int, width: int) -> Moments | None:
    """None if a fold or label is -1 or readings are not finite."""
    sizes = packed.groupBy("fold", "label").agg(F.sum("n").alias("n")).collect()
    if any(r.fold < 0 or r.label < 0 for r in sizes):
        return None
    n, ones = np.zeros(folds, np.int64), np.zeros(folds, np.int64)
    for r in sizes:
        n[r.fold] += r.n
        ones[r.fold] += int(r.label) * r.n
    one = packed.select("fold", F.posexplode(F.arrays_zip("known", "mean", "m2")).alias("i", "c")).select("fold", "i", "c.*")
    middle = {r.i: r.m for r in one.groupBy("i").agg(F.try_divide(F.sum(F.col("known") * F.col("mean")), F.sum("known")).alias("m")).collect()}
    if len(middle) < width or any(m is None or not math.isfinite(m) for m in middle.values()):
        return None
    off = F.col("mean") - F.element_at(F.array(*[F.lit(float(middle[i])) for i in range(width)]), F.col("i") + 1)
    made = one.groupBy("fold", "i").agg(
        F.sum("known").alias("k"), F.sum(F.col("known") * off).alias("s"), F.sum(F.col("m2") + F.col("known") * off * off).alias("q"))
    known, mean, m2 = (np.zeros((folds, width)) for _ in range(3))
    for r in made.collect():
        away = r.s / r.k if r.k else 0.0
        known[r.fold, r.i], mean[r.fold, r.i], m2[r.fold, r.i] = r.k, middle[r.i] + away, max(0.0, r.q - r.k * away * away)
    return Moments(n, ones, known, mean, m2) if np.isfinite(m2).all() else None


@dataclass(frozen=True)
class Design:
    """Columns that all folds share: one, the readings standardised over all rows (0 if missing), and for each column
    with gaps whether the reading is missing. The standardised readings of a fold's training rows are linear in them."""

    mean: np.ndarray
    scale: np.ndarray
    gaps: tuple[int, ...]

    @classmethod
    def over(cls, m: Moments) -> Design:
        mean, std = m.of(range(len(m.n)))
        gaps = tuple(int(j) for j in np.flatnonzero(m.known.sum(axis=0) < m.n.sum()))
        return cls(mean, np.where(std > 0, std, 1.0), gaps)

    @property
    def width(self) -> int:
        return 1 + len(self.mean) + len(self.gaps)

    def matrix(self, x: np.ndarray) -> np.ndarray:
        u = (x - self.mean[:, None]) / self.scale[:, None]
        missing = np.isnan(u)
        u[missing] = 0.0
        return np.concatenate([np.ones((1, x.shape[1])), u, missing[list(self.gaps)].astype(np.float64)])

    def change(self, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
        """A with coefficients in the shared columns = A @ (intercept and coefficients after standardising by mean, std)."""
        made, p = np.zeros((self.width, 1 + len(mean))), len(mean)
        made[0, 0] = 1.0
        for j in np.flatnonzero(std > 0):
            away = (self.mean[j] - mean[j]) / std[j]
            made[0, 1 + j], made[1 + j, 1 + j] = away, self.scale[j] / std[j]
            if j in self.gaps:
                made[1 + p + self.gaps.index(j), 1 + j] = -away
        return made


def _matrices(batches: Iterator[pa.RecordBatch], design: Design) -> Iterator[tuple[int, float, np.ndarray]]:
    for batch in batches:
        for fold, label, x in zip(*(batch.column(c) for c in ("fold", "label", "x"))):
            flat = np.frombuffer(x.as_buffer(), np.float64)
            yield fold.as_py(), label.as_py(), design.matrix(flat.reshape(len(design.mean), -1))


# Sums of a pass: per fold of the rows and model, loss, gradient and Hessian in the shared columns.


def _logistic_sums(design: Design, models: Mapping[int, np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """mapInArrow body; ``models``: the coefficients to look at on a fold's rows, one row each."""
    d = design.width
    left, right = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {g: np.zeros((len(m), 1 + d + len(left))) for g, m in models.items()}
        for fold, label, columns in _matrices(batches, design):
            at, out = models[fold], sums[fold]
            if not len(at):
                continue
            step = max(16, min(STEP_ROWS, STEP_CELLS // len(at)))
            for lo in range(0, columns.shape[1], step):
                t = np.ascontiguousarray(columns[:, lo : lo + step])
                eta, ones = at @ t, t.sum(axis=1)
                away = np.abs(eta)
                line = at @ ones
                out[:, 0] += (away.sum(axis=1) + (-line if label else line)) / 2
                e = np.exp(np.negative(away, out=away), out=away)
                more = 1.0 + e
                out[:, 0] += np.log(np.multiply.reduce(more, axis=1))
                sure = np.reciprocal(more, out=more)
                weight = np.multiply(np.multiply(e, sure, out=e), sure, out=e)
                lean = np.copysign(np.subtract(sure, 0.5, out=sure), eta, out=sure)  # probability of class 1, less 1/2
                out[:, 1 : 1 + d] += lean @ t.T + (-ones / 2 if label else ones / 2)
                out[:, 1 + d :] += weight @ (t[left] * t[right]).T
        for g, s in sums.items():
            if s.size:
                yield pa.RecordBatch.from_pydict({"fold": np.full(s.size, g, np.int32), "i": np.arange(s.size, dtype=np.int32), "v": s.ravel()})

    return run


@dataclass(frozen=True)
class Quadratic:
    """Loss, gradient and Hessian of some rows at a point of the shared columns."""

    loss: float
    slope: np.ndarray
    bend: np.ndarray
    at: np.ndarray


def _pass(packed: DataFrame, design: Design, models: Mapping[int, np.ndarray]) -> dict[int, list[Quadratic]]:
    """Per fold of the rows, the sums at each of its models. What comes to the driver doesn't grow with the rows."""
    d = design.width
    summed = packed.select("fold", "label", "x").mapInArrow(_logistic_sums(design, models), "fold int, i int, v double")
    flat = {g: np.zeros(len(m) * (1 + d + d * (d + 1) // 2)) for g, m in models.items()}
    for r in summed.groupBy("fold", "i").agg(F.sum("v").alias("v")).collect():
        flat[r.fold][r.i] = r.v
    made = {}
    for g, m in models.items():
        made[g] = []
        for at, s in zip(m, flat[g].reshape(len(m), 1 + d + d * (d + 1) // 2)):
            bend = np.zeros((d, d))
            bend[np.triu_indices(d)] = s[1 + d :]
            made[g].append(Quadratic(float(s[0]), s[1 : 1 + d], bend + np.triu(bend, 1).T, at))
    return made


def _added(parts: Sequence[Quadratic]) -> Quadratic:
    return Quadratic(sum(q.loss for q in parts), sum(q.slope for q in parts), sum(q.bend for q in parts), parts[0].at)


def _least(q: Quadratic, change: np.ndarray, n: int, penalty: Penalty, start: np.ndarray) -> np.ndarray:
    """Where the quadratic plus penalty is least; by coordinates if the penalty has corners."""
    h = change.T @ q.bend @ change / n
    b = change.T @ (q.slope - q.bend @ q.at) / n
    h[np.arange(1, len(h)), np.arange(1, len(h))] += penalty.smooth
    if not penalty.sharp:
        return np.linalg.lstsq(h, -b, rcond=1e-14)[0]
    theta = start.copy()
    for _ in range(1000):
        most = 0.0
        for j in range(len(theta)):
            pull = h[j, j] * theta[j] - b[j] - h[j] @ theta
            if j:
                pull = math.copysign(max(0.0, abs(pull) - penalty.sharp), pull)
            new = pull / h[j, j] if h[j, j] > 0 else 0.0
            most, theta[j] = max(most, abs(new - theta[j])), new
        if most <= 1e-12 * max(1.0, float(np.abs(theta).max())):
            break
    return theta


class _Fit:
    """Newton's method on one objective: ``trial`` is to be looked at next; steps that don't improve are halved."""

    def __init__(self, change: np.ndarray, n: int, penalty: Penalty, near: float):
        self.change, self.n, self.penalty, self.near = change, n, penalty, near
        self.theta, self.value, self.trial, self.looks, self.done = np.zeros(change.shape[1]), math.inf, None, 0, False

    def begin(self, q: Quadratic) -> _Fit:
        """From sums at a point that need not be one of this objective's own."""
        self.trial = _least(q, self.change, self.n, self.penalty, self.theta)
        return self

    def look(self, q: Quadratic) -> None:
        self.looks += 1
        value = q.loss / self.n + self.penalty.of(self.trial)
        if value <= self.value + 1e-12 * abs(self.value):
            self.theta, self.value = self.trial, value
            self.trial = _least(q, self.change, self.n, self.penalty, self.theta)
            self.done = self._step() <= self.near
        else:
            self.trial = (self.theta + self.trial) / 2
            self.done = self._step() <= 1e-14
        if not self.done and self.looks >= self.penalty.rounds:
            self.trial, self.done = self.theta, True

    def _step(self) -> float:
        return float(np.abs(self.trial - self.theta).max()) / max(1.0, float(np.abs(self.theta).max()))


def fits(packed: DataFrame, m: Moments, design: Design, settings: Sequence[Penalty]) -> list[list[np.ndarray]]:
    """Per fold and setting, the coefficients in the shared columns, fitted to the rows of the other folds."""
    folds = range(len(m.n))
    n, ones = int(m.n.sum()), int(m.ones.sum())
    start = np.zeros(design.width)
    start[0] = math.log(ones / (n - ones))
    # All settings start from the same point, and come near their optimum over all rows before the folds part.
    first = _pass(packed, design, {g: start[None] for g in folds})
    sums = {(g, k): first[g][0] for g in folds for k in range(len(settings))}
    whole = design.change(*m.of(folds))
    common = [_Fit(whole, n, s, NEAR) for s in settings]
    for k, one in enumerate(common):
        one.trial = start[: whole.shape[1]]
        one.look(_added([sums[g, k] for g in folds]))
    while open_ := [k for k, one in enumerate(common) if not one.done]:
        at = np.array([whole @ common[k].trial for k in open_])
        seen = _pass(packed, design, {g: at for g in folds})
        for i, k in enumerate(open_):
            sums.update({(g, k): seen[g][i] for g in folds})
            common[k].look(_added([seen[g][i] for g in folds]))
    each = {}
    for f in folds:
        others = [g for g in folds if g != f]
        change = design.change(*m.of(others))
        for k, s in enumerate(settings):
            each[f, k] = _Fit(change, int(m.n[others].sum()), s, DONE).begin(_added([sums[g, k] for g in others]))
    while open_ := [key for key, one in each.items() if not one.done]:
        point = {key: each[key].change @ each[key].trial for key in open_}
        asked = {g: [key for key in open_ if key[0] != g] for g in folds}
        seen = _pass(packed, design, {g: np.array([point[k] for k in asked[g]]).reshape(-1, design.width) for g in folds})
        found = {g: dict(zip(asked[g], seen[g])) for g in folds}
        for key in open_:
            each[key].look(_added([found[g][key] for g in folds if g != key[0]]))
    return [[each[f, k].change @ each[f, k].trial for k in range(len(settings))] for f in folds]


# Exact areas under the ROC curve.


def _scores(columns: np.ndarray, models: np.ndarray) -> np.ndarray:
    """One row per model, without the intercept; in a fixed order of sums, so that equal rows have equal scores."""
    made = np.zeros((len(models), columns.shape[1]))
    for j in range(1, len(columns)):
        made += models[:, j : j + 1] * columns[j]
    return made


def _deal(design: Design, models: Mapping[int, np.ndarray], borders: Mapping[int, np.ndarray]):
    """mapInArrow body: sorted distinct scores of a block by model and range, with their counts if any is above 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fold, label, columns in _matrices(batches, design):
            rows = []
            for k, s in enumerate(np.sort(_scores(columns, models[fold]), axis=1)):
                heads = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
                s, times = s[heads], np.diff(np.append(heads, len(s)))
                cuts = np.searchsorted(s, borders[fold][k], side="left")
                for part, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(s)])):
                    if lo < hi:
                        counts = times[lo:hi]
                        rows.append((fold, k, part, label, s[lo:hi].tobytes(), counts.tobytes() if (counts > 1).any() else b""))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _DEALT.types)], schema=_DEALT)

    return run


_DEALT = pa.schema([("fold", pa.int32()), ("k", pa.int32()), ("part", pa.int32()), ("label", pa.float64()), ("s", pa.binary()), ("times", pa.binary())])


def _pairs(table: pa.Table) -> pa.Table:
    """Of one model and range: rows of either class, and twice the pairs in which class 1 scores higher, ties once."""
    held: dict[bool, list] = {False: [], True: []}
    for label, s, times in zip(*(table.column(c) for c in ("label", "s", "times"))):
        s = np.frombuffer(s.as_buffer(), np.float64)
        times = np.frombuffer(times.as_buffer(), np.int64) if len(times.as_buffer()) else None
        held[label.as_py() == 1.0].append((s, times))
    sides = {}
    for one, parts in held.items():
        s = np.concatenate([p[0] for p in parts] or [np.zeros(0)])
        if all(p[1] is None for p in parts):
            sides[one] = np.sort(s), np.ones(len(s), np.int64)
        else:
            times = np.concatenate([np.ones(len(p[0]), np.int64) if p[1] is None else p[1] for p in parts])
            order = np.argsort(s)
            sides[one] = s[order], times[order]
    (low, n_low), (high, n_high) = sides[False], sides[True]
    below = np.concatenate([[0], np.cumsum(n_low)])
    twice = (n_high * (below[np.searchsorted(low, high, side="left")] + below[np.searchsorted(low, high, side="right")])).sum()
    first = {c: table.column(c)[0].as_py() for c in ("fold", "k", "part")}
    row = first | {"zeros": int(n_low.sum()), "ones": int(n_high.sum()), "twice": int(twice)}
    return pa.Table.from_pylist([row], schema=pa.schema([(c, pa.int32() if c in first else pa.int64()) for c in row]))


@contextmanager
def _shuffle_files_go(spark) -> Iterator[None]:
    """Rounds of scores leave nothing on the executors' disks."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _border_rows(packed: DataFrame, design: Design, folds: int) -> dict[int, np.ndarray]:
    """Some rows of every block; they only place the borders between ranges, all rows are counted."""
    each = max(1, BORDER_ROWS // max(1, packed.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fold, _, columns in _matrices(batches, design):
            some = columns[:, :: max(1, columns.shape[1] // each)][:, :each]
            yield pa.RecordBatch.from_pydict({"fold": np.array([fold], np.int32), "t": [np.ascontiguousarray(some).tobytes()]})

    found: dict[int, list] = {f: [np.zeros((design.width, 0))] for f in range(folds)}
    for r in packed.select("fold", "label", "x").mapInArrow(run, "fold int, t binary").collect():
        found[r.fold].append(np.frombuffer(r.t, np.float64).reshape(design.width, -1))
    return {f: np.concatenate(parts, axis=1) for f, parts in found.items()}


def areas(packed: DataFrame, m: Moments, design: Design, models: Sequence[Sequence[np.ndarray]]) -> np.ndarray:
    """Area under the ROC curve of every fold's models on its rows. A model without weights scores all rows alike.

    Without rows of class 1 the area is 0, else without rows of class 0 it is 1, as in Spark's evaluator.
    """
    folds, settings = len(models), len(models[0])
    made = np.full((folds, settings), 0.5)
    made[m.ones == m.n] = 1.0
    made[m.ones == 0] = 0.0
    both = (m.ones > 0) & (m.ones < m.n)
    use = [k for k in range(settings) if any(both[f] and models[f][k][1:].any() for f in range(folds))]
    if not use:
        return made
    ranges = math.ceil(int(m.n.max()) / RANGE_ROWS)
    some = _border_rows(packed, design, folds) if ranges > 1 else None
    at_once = max(ROUND_SETTINGS, ROUND_BYTES // (8 * int(m.n.sum())))
    for lo in range(0, len(use), at_once):
        part = use[lo : lo + at_once]
        at, borders = {}, {}
        for f in range(folds):
            at[f] = np.array([models[f][k] for k in part])
            borders[f] = np.zeros((len(part), 0))
            if some is not None and some[f].shape[1]:
                ordered = np.sort(_scores(some[f], at[f]), axis=1)
                borders[f] = ordered[:, np.arange(1, ranges) * ordered.shape[1] // ranges]
        with _shuffle_files_go(packed.sparkSession):
            dealt = packed.select("fold", "label", "x").mapInArrow(
                _deal(design, at, borders), "fold int, k int, part int, label double, s binary, times binary")
            counted = dealt.groupBy("fold", "k", "part").applyInArrow(
                _pairs, "fold int, k int, part int, zeros bigint, ones bigint, twice bigint")
            rows = sorted(counted.collect(), key=lambda r: (r.fold, r.k, r.part))
        zeros, twice = {}, {}
        for r in rows:
            key = r.fold, r.k
            below = zeros.get(key, 0)
            twice[key] = twice.get(key, 0) + r.twice + 2 * r.ones * below
            zeros[key] = below + r.zeros
        for (f, k), pairs in twice.items():
            if both[f]:
                made[f, part[k]] = pairs / (2 * int(m.ones[f]) * int(m.n[f] - m.ones[f]))
    return made


def folded_auc(df: DataFrame, pipeline: Pipeline, settings: Sequence[Mapping], label: str, folds: int, fold_column: str) -> list[float] | None:
    """Mean area under the ROC curve of every setting over the folds, or None where only Spark's own search will do.

    That is: another pipeline or searched parameter, fewer than 50 iterations, labels other than 0 and 1, folds out of
    range, empty or not whole numbers, a training set of one class, infinite readings, a column without readings or with
    gaps that Spark fills in another type, very many columns.
    """
    wanted = penalties(pipeline, settings, label)
    features = pipeline.getStages()[0].getInputCols() if wanted else []
    if not wanted or 1 + 2 * len(features) > WIDEST or not isinstance(df.schema[fold_column].dataType, T.IntegralType):
        return None
    packed = blocks(df, features, label, folds, fold_column)
    m = moments(packed, folds, len(features))
    if m is None or not m.n.all():
        return None
    for f in range(folds):
        others = [g for g in range(folds) if g != f]
        if not others or not 0 < m.ones[others].sum() < m.n[others].sum() or not m.known[others].sum(axis=0).all():
            return None
    design = Design.over(m)
    if any(not isinstance(df.schema[features[j]].dataType, T.DoubleType) for j in design.gaps):
        return None
    return [float(v) for v in areas(packed, m, design, fits(packed, m, design, wanted)).mean(axis=0)]
