"""Product codes of vectors: integer codebooks by ball k-means, which asks only for entries that can be nearest."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.joins import join_small
from tidemark.plans.scratch import written

ROWS_AT_ONCE = 1 << 15
#: components beyond this in size have squared distances that do not fit 64 bits
LARGEST = 1 << 27


@dataclass
class Codebooks:
    """One array (entries, width) of integers per part of the vector."""

    parts: list[np.ndarray]

    @property
    def borders(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum([p.shape[1] for p in self.parts])))

    def digest(self) -> str:
        text = ",".join(str(int(x)) for p in self.parts for x in p.ravel())
        return hashlib.sha256(text.encode()).hexdigest()


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


def ball_assign(x: np.ndarray, owner: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of every row of ``x`` (ties: the lower index), its squared distance, distances computed.

    The rows that ``owner`` names for an entry are its ball; any owner is right, a near one saves work. An entry is a
    neighbour of a ball if the square of its distance to the ball's centre is at most four squared radii: no other can
    be as near to any row of the ball. Rows whose four squared distances stay below that of the nearest neighbour are
    the stable core and keep their owner. The others lie in rings: a row is compared with just as many neighbours, in
    order of distance from the centre, as its own distance reaches. All in integers, so ties are exact.
    """
    between = squared(entries[:, None, :], entries[None, :, :])
    order = np.argsort(between, axis=1, kind="stable")
    own = squared(x, entries[owner])
    best, nearest = own.copy(), owner.copy()
    asked = len(x)
    by_ball = np.argsort(owner, kind="stable")
    edge = np.searchsorted(owner[by_ball], np.arange(len(entries) + 1))
    for ball, (lo, hi) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
        rows = by_ball[lo:hi]
        if not len(rows):
            continue
        near = order[ball][order[ball] != ball]
        near = near[between[ball, near] <= 4 * own[rows].max()]
        if not len(near):
            continue
        ring = np.searchsorted(between[ball, near], 4 * own[rows], side="right")
        for n, entry in enumerate(near.tolist()):
            some = rows[ring > n]
            if not len(some):
                break
            far = squared(x[some], entries[entry])
            asked += len(some)
            closer = (far < best[some]) | ((far == best[some]) & (entry < nearest[some]))
            best[some[closer]], nearest[some[closer]] = far[closer], entry
    return nearest, best, asked


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def _owners(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), parts).astype(np.int64)


def _blocks(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def with_codes(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` (with ``v``, the integers, and perhaps ``code``, owners to begin with) with new ``code``, ``error``."""
    keep = [c for c in rows.columns if c not in ("code", "error")]
    fields = [T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]
    schema = T.StructType([rows.schema[c] for c in keep] + fields)
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = sent.value
        borders = books.borders
        for block in _blocks(batches):
            v = _matrix(block.column("v"), int(borders[-1]))
            code = np.zeros((len(v), len(books.parts)), np.int64)
            if "code" in block.schema.names:
                code = _owners(block.column("code"), len(books.parts))
            error = np.zeros(len(v), np.int64)
            for p, entries in enumerate(books.parts):
                code[:, p], far, _ = ball_assign(v[:, borders[p] : borders[p + 1]], code[:, p], entries)
                error += far
            made = pa.array([r.tobytes() for r in code.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*[block.column(c) for c in keep], made, pa.array(error)], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The entries after one round: the floor of the mean of the rows nearest to each; entries without rows stay.

    Every task sends one row an entry; what reaches the driver has the size of the codebooks.
    """
    sent = rows.sparkSession.sparkContext.broadcast(books)
    widest = max(p.shape[1] for p in books.parts)

    def sums(batches):
        books = sent.value
        borders = books.borders
        total = [np.zeros((len(p), p.shape[1] + 1), object) for p in books.parts]
        for block in _blocks(batches):
            v = _matrix(block.column("v"), int(borders[-1]))
            code = _owners(block.column("code"), len(books.parts))
            for p, entries in enumerate(books.parts):
                x = v[:, borders[p] : borders[p + 1]]
                nearest, _, _ = ball_assign(x, code[:, p], entries)
                part = np.zeros((len(entries), x.shape[1] + 1), np.int64)
                np.add.at(part, nearest, np.concatenate((x, np.ones((len(x), 1), np.int64)), axis=1))
                total[p] = total[p] + part
        made = [(p, e, int(row[-1]), [str(s) for s in row[:-1]])
                for p, t in enumerate(total) for e, row in enumerate(t) if row[-1]]
        columns = list(zip(*made)) if made else [[]] * 4
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "entry", "n", "sums"])

    made = rows.select("v", "code").mapInArrow(sums, "part int, entry int, n bigint, sums array<string>")
    total = made.groupBy("part", "entry").agg(
        F.sum("n"), *[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(widest)])
    out = [p.copy() for p in books.parts]
    for part, entry, n, *of in total.collect():
        width = out[part].shape[1]
        out[part][entry] = [int(s) // n for s in of[:width]]
    return Codebooks(out)


def integers(vectors: DataFrame, id_col: str, vector: str, label: str, scale: int) -> DataFrame:
    """vec_id, label and ``v`` = floor(scale * x) of the vectors that have integers.

    Null vectors, vectors with null or non-finite components or with integers beyond LARGEST, and vectors of another
    length than most (ties: the longer) are left out.
    """
    x = F.col("x")
    scaled = F.transform("x", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    sane = lambda c: F.coalesce(F.abs(c.cast("double") * scale) <= LARGEST, F.lit(False))
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("x"))
    rows = rows.where(x.isNotNull() & F.forall("x", lambda c: sane(c) & ~F.isnan(c.cast("double"))) & (F.size(x) > 0))
    rows = rows.select("vec_id", "label", scaled.alias("v"))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (usual[0] if usual else 0))


def compressed(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    refresh: int = 3,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """(rows, codebooks): vec_id, label, v, code (one byte a part) and error of every vector, and the entries.

    Codebooks begin with the parts of the ``entries`` smallest vec_ids (repeated ids in order of their integers; fewer
    vectors, fewer entries), and move ``rounds`` times. A round reads the rows once and writes nothing: owners are those
    last written, at the start and every ``refresh`` rounds, and a ball around an older owner is as exact as any. When no
    entry moves, later rounds would not either and are left out. Lengths that ``parts`` does not divide are cut at
    floor(i * length / parts). Left out are the rows that ``integers`` leaves out; a null id is kept, and never among the
    smallest.
    """
    rows = written(integers(vectors, id_col, vector, label, scale), "integers")
    first = rows.where("vec_id is not null").orderBy("vec_id", "v").limit(entries).select("v").collect()
    if not first:
        first = rows.orderBy("v").limit(entries).select("v").collect()
    start = np.array([r.v for r in first], np.int64)
    if not len(start):
        none = rows.withColumns({"code": F.lit(b""), "error": F.lit(0).cast("long")})
        return none, Codebooks([np.zeros((0, 0), np.int64)] * parts)
    cut = [i * start.shape[1] // parts for i in range(parts + 1)]
    books = Codebooks([np.ascontiguousarray(start[:, a:b]) for a, b in zip(cut, cut[1:])])
    state = rows
    for done in range(rounds):
        if done % refresh == 0:
            state = written(with_codes(state, books).drop("error"), "owners")
        before, books = books, _moved(state, books)
        if all(np.array_equal(a, b) for a, b in zip(before.parts, books.parts)):
            break
    return with_codes(state, books), books


def code_report(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and codebooks_sha256 of every coded vector.

    label_error is the error summed over the rows of one label; rows without a label belong together.
    """
    rows, books = compressed(vectors, **options)
    named = F.struct(F.col("label").isNull().alias("none"), F.coalesce(F.col("label").cast("string"), F.lit(""))).alias("l")
    rows = written(rows.select("vec_id", named, "code", "error"), "codes")
    by_label = rows.groupBy("l").agg(F.sum("error").alias("label_error"))
    return join_small(rows, by_label, ["l"]).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"))
