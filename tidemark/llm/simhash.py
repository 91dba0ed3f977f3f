"""SimHash fingerprints and exact near-duplicate groups by pigeonring filtering."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import LOWER, SPACED, Words, with_text_columns
from tidemark.llm.graph import components
from tidemark.plans.scratch import written

SEED = 42
SEGMENTS = 16
SEGMENT_BITS = 64 // SEGMENTS
BLOCK = 4096
PAIRS_AT_ONCE = 1 << 20


def fingerprints_of(data: np.ndarray, borders: np.ndarray, shingle: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text."""
    words = Words(data, borders, SPACED, hashes=False)
    out = np.zeros(len(borders) - 1, np.uint64)
    if not len(words.start):
        return out
    # the text with one blank after each word
    put = SPACED[data]
    blank = words.end[words.end < len(data)]
    put[blank[~put[blank]]] = True
    plain = np.where(SPACED[data], LOWER[data], np.uint8(32))[put].tobytes()
    at = np.concatenate(([0], np.cumsum(put)))
    start, end = at[words.start], at[words.end - 1] + 1
    size = np.minimum(words.count, shingle)
    many = np.where(words.count > 0, words.count - size + 1, 0)
    first = np.repeat(words.bounds[:-1], many)
    border = np.concatenate(([0], np.cumsum(many)))
    nth = first + np.arange(len(first)) - np.repeat(border[:-1], many)
    a, b = start[nth], end[nth + np.repeat(size, many) - 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(plain[i:j], SEED) for i, j in zip(a.tolist(), b.tolist())), np.uint64, len(a))
    full = np.flatnonzero(many)
    ones = np.zeros((len(full), 64), np.int64)
    step = 1 << 18
    for lo in range(0, len(hashes), step):
        part = hashes[lo : lo + step]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        touched = (border[full] < lo + len(part)) & (border[full + 1] > lo)
        inner = np.maximum(border[full[touched]], lo) - lo
        ones[touched] += np.add.reduceat(bits, inner, axis=0, dtype=np.int32)
    set_bits = ones * 2 > many[full][:, None]
    out[full] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(
    docs: DataFrame, shingle: int = 3, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``keep`` columns plus ``simhash`` (bigint with the 64 bits); texts without a word have fingerprint zero."""

    def compute(data, borders):
        return {"simhash": pa.array(fingerprints_of(data, borders, shingle).view(np.int64))}

    return with_text_columns(docs, text, compute, [T.StructField("simhash", T.LongType(), False)], keep)


def chain_holds(differing: np.ndarray, start: np.ndarray, most: int) -> np.ndarray:
    """Whether segment chains from ``start`` keep every cumulative difference within length * most / SEGMENTS."""
    shifts = np.arange(SEGMENTS, dtype=np.uint64) * np.uint64(SEGMENT_BITS)
    mask = np.uint64((1 << SEGMENT_BITS) - 1)
    per_segment = np.bitwise_count((differing[:, None] >> shifts) & mask).astype(np.int64)
    ring = (start[:, None] + np.arange(SEGMENTS)) % SEGMENTS
    sums = np.cumsum(np.take_along_axis(per_segment, ring, axis=1), axis=1)
    return (sums * SEGMENTS <= np.arange(1, SEGMENTS + 1) * most).all(axis=1)


class Forest:
    """Union-find over the nodes one task sees; keeps only edges that join two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def add(self, pairs) -> None:
        for a, b in pairs:
            x, y = self.root(a), self.root(b)
            if x != y:
                self.up[max(x, y)] = min(x, y)
                self.edges.append((a, b))

    def take(self) -> list[tuple[int, int]]:
        """The edges so far; what was joined stays joined while memory is small."""
        made, self.edges = self.edges, []
        if len(self.up) > 1_000_000:
            self.up = {}
        return made


def pairs_within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs i < j inside consecutive runs of the given sizes."""
    first = np.repeat(np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    place = np.arange(int(sizes.sum())) - first
    later = np.repeat(sizes, sizes) - place - 1
    i = np.repeat(np.arange(len(place)), later)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
    return i, j


def _bucket_links(most: int):
    """mapInArrow body: rows sorted by (start, bucket, x, y, side, fp) give forest edges between nodes."""

    def close(fp, node, start, i, j):
        ok = chain_holds(fp[i] ^ fp[j], start[i], most)
        i, j = i[ok], j[ok]
        ok = np.bitwise_count(fp[i] ^ fp[j]) <= most
        return zip(node[i[ok]].tolist(), node[j[ok]].tolist())

    def groups(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = [batch.column(c).to_numpy() for c in ("start", "bucket", "x", "y")]
            new = np.flatnonzero(np.any([g[1:] != g[:-1] for g in group], axis=0)) + 1
            last = int(new[-1]) if len(new) else 0
            if held and any(held[-1].column(c)[0] != batch.column(c)[0] for c in ("start", "bucket", "x", "y")):
                yield held
                held = []
            if last:
                yield [*held, batch.slice(0, last)]
                held = []
            held.append(batch.slice(last))
        if held:
            yield held

    def run(batches):
        forest = Forest()
        for part in groups(batches):
            rows = pa.Table.from_batches(part)
            fp = rows.column("fp").to_numpy().view(np.uint64)
            node, start = rows.column("node").to_numpy(), rows.column("start").to_numpy()
            x, y, side = (rows.column(c).to_numpy() for c in ("x", "y", "side"))
            key = [rows.column(c).to_numpy() for c in ("start", "bucket", "x", "y")]
            cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            edge = np.concatenate(([0], cut, [len(fp)]))
            sizes = np.diff(edge)
            small = sizes <= 64
            # many small buckets at once
            inside = np.repeat(small, sizes)
            rows_of = np.flatnonzero(inside)
            counts = sizes[small]
            at = 0
            while at < len(counts):
                pairs = np.cumsum(counts[at:].astype(np.int64) ** 2)
                to = at + max(1, int(np.searchsorted(pairs, PAIRS_AT_ONCE, side="right")))
                base = int(counts[:at].sum())
                i, j = pairs_within(counts[at:to])
                i, j = rows_of[base + i], rows_of[base + j]
                between = (x[i] == y[i]) | (side[i] != side[j])
                forest.add(close(fp, node, start, i[between], j[between]))
                at = to
            for lo, hi in zip(edge[:-1][~small], edge[1:][~small]):
                one = side[lo:hi]
                left = lo + (np.flatnonzero(one == 0) if x[lo] != y[lo] else np.arange(hi - lo))
                right = lo + (np.flatnonzero(one == 1) if x[lo] != y[lo] else np.arange(hi - lo))
                rest = max(1, PAIRS_AT_ONCE // max(1, len(right)))
                for k in range(0, len(left), rest):
                    some = left[k : k + rest]
                    near = np.bitwise_count(fp[some][:, None] ^ fp[right][None, :]) <= most
                    p, q = np.nonzero(near)
                    p, q = some[p], right[q]
                    forest.add(close(fp, node, start, p[p != q], q[p != q]))
            made = forest.take()
            if made:
                ends = np.array(made, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    return run


def links(fps: DataFrame, most: int = 2) -> DataFrame:
    """Edges (a, b) between nodes whose fingerprints differ in at most ``most`` bits, enough to join every group.

    ``fps`` has distinct ``fp`` with a ``node``. Fingerprints are cut into a ring of SEGMENTS segments. If two differ
    in at most ``most`` bits, then from some segment on every chain of l segments differs in at most l * most /
    SEGMENTS bits; so the first chains, while that bound is below 1, are equal, and their bits are the bucket in
    which the two meet. In a bucket the full chain condition prunes pairs before the Hamming check. Buckets of more
    than BLOCK fingerprints are compared block by block in tasks of their own. A task returns a spanning forest of
    its links, not the pairs. Exact: no bucket is capped.
    """
    equal = -(-SEGMENTS // most) - 1 if most else SEGMENTS
    width = equal * SEGMENT_BITS
    mask = (1 << width) - 1 if width < 64 else -1
    turned = []
    for i in range(SEGMENTS if most else 1):
        by = i * SEGMENT_BITS
        ring = F.shiftrightunsigned("fp", by).bitwiseOR(F.shiftleft("fp", 64 - by)) if by else F.col("fp")
        turned.append(F.struct(F.lit(i).alias("start"), ring.bitwiseAND(F.lit(mask)).alias("bucket")))
    entries = fps.select("fp", "node", F.explode(F.array(*turned)).alias("e")).select("fp", "node", "e.*")
    bucket = Window.partitionBy("start", "bucket")
    entries = entries.withColumns({
        "n": F.count("*").over(bucket),
        "at": F.row_number().over(bucket.orderBy("fp")) - 1,
    }).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    entries = entries.withColumn("own", F.floor(F.col("at") / BLOCK).cast("int"))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    entries = entries.select(
        "start", "bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp", "node",
    )
    group = ["start", "bucket", "x", "y"]
    entries = entries.repartition(*group).sortWithinPartitions(*group, "side", "fp")
    return entries.mapInArrow(_bucket_links(most), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    most: int = 2,
    shingle: int = 3,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row with its fingerprint and its group: doc_id, simhash, component_id.

    Rows whose fingerprints differ in at most ``most`` bits are linked; component_id is the smallest doc_id reachable
    by links. Equal fingerprints become one node before any comparison, so copies cost one row. Null and empty texts
    have fingerprint zero and are linked like any other. A null doc_id cannot name a group: such rows belong to the
    group of their fingerprint where another row names it, else they get null. Rows that share a doc_id are one node.
    """
    each = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("__t"))
    each = written(fingerprints(each, shingle, ["doc_id"], "__t"), "simhash")
    fps = each.groupBy(F.col("simhash").alias("fp")).agg(F.min("doc_id").alias("node")).where("node is not null")
    fps = written(fps, "fps")
    groups = components(links(fps, most))
    named = fps.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return each.join(named, each["simhash"] == named["fp"], "left").select("doc_id", "simhash", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents that name their group (the smallest doc_id); rows without an id have no group and stay.

    Repeated rows of a kept document are reduced to one.
    """
    groups = near_duplicates(docs, **options)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    rows = docs.join(kept, docs["doc_id"] == kept["__kept"], "left_semi").dropDuplicates(["doc_id"])
    return rows.union(docs.where(F.col("doc_id").isNull()))
