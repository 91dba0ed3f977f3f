"""Exact near-duplicate links of vectors by cover trees that are walked in pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.simhash import Forest
from tidemark.plans.scratch import written

CHUNK = 2048
LEVELS = 5
SLACK = 1e-9


class CoverTree:
    """Nested nets over unit vectors: a level's centres lie apart by its radius, radii halve from level to level, and
    every centre of a level is a centre of the next. ``reach`` is the exact distance to the farthest vector below."""

    def __init__(self, unit: np.ndarray):
        self.unit = unit
        n = len(unit)
        self.centres: list[np.ndarray] = []
        self.parents: list[np.ndarray] = []  # of each centre: place of its parent in the level above
        self.reach: list[np.ndarray] = []
        net = np.zeros(1, np.int64)
        radius = 2.0
        for _ in range(LEVELS):
            if radius < 2.0:
                net = self._net(net, radius)
            self.centres.append(net)
            radius /= 2
        self.centres.append(np.arange(n))
        near = None
        for upper, lower in zip(self.centres[:-1], self.centres[1:]):
            self.parents.append(self._nearest(lower, upper))
        owner = np.arange(n)
        self.reach = [np.zeros(n)]
        for k in range(len(self.centres) - 2, -1, -1):
            owner = self.parents[k][owner]
            apart = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", unit, unit[self.centres[k]][owner]), 0))
            near = np.zeros(len(self.centres[k]))
            np.maximum.at(near, owner, apart)
            self.reach.insert(0, near + SLACK)

    def _net(self, net: np.ndarray, radius: float) -> np.ndarray:
        bound = 1 - radius * radius / 2  # cosine at that distance
        free = np.ones(len(self.unit), bool)
        for lo in range(0, len(net), 512):
            free &= ~(self.unit @ self.unit[net[lo : lo + 512]].T > bound).any(axis=1)
        free[net] = False
        more = []
        left = np.flatnonzero(free)
        while len(left):
            # within one block the earlier vector is the centre; what a block's centres cover drops out
            block = left[:256]
            close = self.unit[block] @ self.unit[block].T > bound
            chosen = np.zeros(len(block), bool)
            for i in range(len(block)):
                if not (close[i, :i] & chosen[:i]).any():
                    chosen[i] = True
            new = block[chosen]
            more.append(new)
            rest = left[256:]
            left = rest[~(self.unit[rest] @ self.unit[new].T > bound).any(axis=1)] if len(rest) else rest
        return np.concatenate([net, *more])

    def _nearest(self, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        out = np.empty(len(lower), np.int64)
        for lo in range(0, len(lower), 512):
            out[lo : lo + 512] = np.argmax(self.unit[lower[lo : lo + 512]] @ self.unit[upper].T, axis=1)
        return out


def dual_pairs(a: CoverTree, b: CoverTree, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with cosine at least ``cosine``. Level by level, a pair of nodes lives on unless its centres are
    farther apart than both reaches and the threshold distance together; pairs of vectors left are compared exactly."""
    far = np.sqrt(max(2 - 2 * cosine, 0.0))
    alive = np.ones((1, 1), bool)
    for k in range(len(a.centres)):
        if k:
            alive = alive[a.parents[k - 1]][:, b.parents[k - 1]]
        rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cos = a.unit[a.centres[k][rows]] @ b.unit[b.centres[k][cols]].T
        if k == len(a.centres) - 1:
            # rounding of a matrix product must not decide a pair at the border
            i, j = np.nonzero(alive[np.ix_(rows, cols)] & (cos >= cosine - 1e-9))
            i, j = a.centres[k][rows][i], b.centres[k][cols][j]
            edge = np.einsum("ij,ij->i", a.unit[i], b.unit[j])
            return i[edge >= cosine], j[edge >= cosine]
        apart = np.sqrt(np.maximum(2 - 2 * cos, 0))
        keep = apart <= a.reach[k][rows][:, None] + b.reach[k][cols][None, :] + far + SLACK
        next_alive = np.zeros_like(alive)
        next_alive[np.ix_(rows, cols)] = alive[np.ix_(rows, cols)] & keep
        alive = next_alive
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def _unit(column: pa.Array) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares must neither overflow nor vanish
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _compare(cosine: float):
    """One pair of chunks: rows (node, n, other): n linked vectors of a node here; other set for forest edges."""

    def run(table: pa.Table) -> pa.Table:
        side, ids, many = (table.column(c).to_numpy() for c in ("side", "node", "many"))
        both = table.column("x")[0].as_py() != table.column("y")[0].as_py()
        vectors = table.column("vector").combine_chunks()
        left = np.flatnonzero(side == 0)
        a = CoverTree(_unit(vectors.take(pa.array(left)))) if len(left) else None
        right = np.flatnonzero(side == 1) if both else left
        b = (CoverTree(_unit(vectors.take(pa.array(right)))) if len(right) else None) if both else a
        counts = np.zeros(len(ids), np.int64)
        forest = Forest()
        if a is not None and b is not None:
            i, j = dual_pairs(a, b, cosine)
            i, j = left[i], right[j]
            other = i != j
            i, j = i[other], j[other]
            np.add.at(counts, i, many[j])
            if both:
                np.add.at(counts, j, many[i])
            # neighbours of an earlier row first: a forest needs one edge per tree joined
            forest.add(zip(ids[i].tolist(), ids[j].tolist()))
        linked = np.flatnonzero(counts)
        node = [*ids[linked].tolist(), *[e[0] for e in forest.edges]]
        n = [*counts[linked].tolist(), *[0] * len(forest.edges)]
        to = [*[None] * len(linked), *[e[1] for e in forest.edges]]
        return pa.table({"node": pa.array(node, pa.int64()), "n": pa.array(n, pa.int64()),
                         "other": pa.array(to, pa.int64())})

    return run


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.93,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Vectors are compared when labels are equal and not null and dimensions agree; n_links counts the other rows with
    cosine of at least ``cosine`` (double precision), component_id is the smallest id reachable by links, kept says
    that it is the row's own. Equal vectors of a label become one node first, with their number. The nodes of a label
    are dealt into chunks of CHUNK; every pair of chunks is one task with a cover tree on each side, so no task grows
    with the label, and a task returns counts and a forest of edges, never its pairs.

    Null, empty and zero vectors, vectors with null or non-finite entries, and null labels link with nothing: 0 links,
    own component. Rows with a null id link with nothing and have a null component. Rows that share an id are vectors of
    their own, with their own links and, where links do not join them, their own components.
    """
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label).alias("__label"), F.col(vector).alias("__vector")
    )
    finite = F.forall("__vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = (
        F.col("vec_id").isNotNull() & F.col("__label").isNotNull() & (F.size("__vector") > 0) & finite
        & F.exists("__vector", lambda v: v != 0)
    )
    rows = rows.withColumn("__ok", F.coalesce(usable, F.lit(False)))
    nodes = rows.where("__ok").groupBy("__label", "__vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("many"))
    # a node is a label and a vector: ids may repeat, so it gets a key of its own, written with it
    nodes = nodes.withColumns({"dim": F.size("__vector"), "node": F.monotonically_increasing_id()})
    nodes = written(nodes, "nodes")
    sizes = nodes.groupBy("__label", "dim").agg(F.count("*").alias("rows"))
    chunks = F.ceil(F.col("rows") / CHUNK).cast("int")
    dealt = nodes.join(sizes, ["__label", "dim"]).withColumn("own", F.pmod(F.xxhash64("id", "__vector"), chunks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    dealt = dealt.select(
        F.col("__label").alias("label"), "dim", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "many", F.col("__vector").alias("vector"),
    )
    # work is the square of a chunk, whatever its bytes: spread the pairs over all tasks
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pair = ["label", "dim", "x", "y"]
    found = dealt.repartition(tasks, *pair).groupBy(*pair).applyInArrow(_compare(cosine), "node bigint, n bigint, other bigint")
    found = written(found, "links")
    counts = found.groupBy("node").agg(F.sum("n").alias("links"))
    groups = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    nodes = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    nodes = written(nodes, "grouped-nodes")
    named = nodes.groupBy("component").agg(F.min("id").alias("least"))
    known = nodes.join(counts, "node", "left").join(named, "component").select(
        F.col("__label").alias("l"), F.col("__vector").alias("v"),
        (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.col("least").alias("component"),
    )
    same = (rows["__label"] == known["l"]) & (rows["__vector"] == known["v"]) & rows["__ok"]
    out = rows.join(known, same, "left").withColumn("component_id", F.coalesce("component", "vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
