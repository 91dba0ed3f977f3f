"""Ranked lexical search over whole documents: equal bags of item words are scored once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import ALNUM, LOWER, Words, flat, pieces, with_text_columns
from tidemark.plans.scratch import written

BLOCK_BYTES = 4 << 20
CELLS_AT_ONCE = 1 << 22
COMPARED_AT_ONCE = 1 << 20
POOL = 1 << 18
LAST = np.iinfo(np.int64).max


class Vocabulary:
    """The distinct lower-cased words of a block of items, and per word the items that hold it, with repeats."""

    def __init__(self, texts: Sequence[str]):
        data, borders = flat(pa.array(list(texts), pa.string()))
        words = Words(data, borders, ALNUM)
        low = LOWER[data].tobytes()
        names = [low[a:b] for a, b in zip(words.start.tolist(), words.end.tolist())]
        known = dict(sorted(zip(names, words.hash.tolist()), key=lambda x: (x[1], x[0])))
        self.size = len(known)
        self.hash = np.fromiter(known.values(), np.uint64, len(known))
        self.data = np.frombuffer(b"".join(known), np.uint8)
        self.borders = np.concatenate(([0], np.cumsum([len(n) for n in known], dtype=np.int64)))
        place = {n: i for i, n in enumerate(known)}
        term = np.fromiter((place[n] for n in names), np.int64, len(names))
        items = max(1, len(texts))
        cell, times = np.unique(term * items + words.owner(), return_counts=True)
        self.item, self.times = cell % items, times
        self.first = np.searchsorted(cell // items, np.arange(self.size + 1))

    def find(self, data: np.ndarray, words: Words) -> np.ndarray:
        """For each word its place in the vocabulary, -1 for none: found by hash, confirmed by comparing bytes."""
        out = np.full(len(words.start), -1)
        if not self.size:
            return out
        at = np.searchsorted(self.hash, words.hash)
        ask = np.arange(len(out))
        while len(ask):
            inside = at[ask] < self.size
            ask = ask[inside]
            ask = ask[self.hash[at[ask]] == words.hash[ask]]
            equal = self._equal(data, words, ask, at[ask])
            out[ask[equal]] = at[ask[equal]]
            ask = ask[~equal]
            at[ask] += 1
        return out

    def _equal(self, data: np.ndarray, words: Words, ask: np.ndarray, at: np.ndarray) -> np.ndarray:
        size = words.end[ask] - words.start[ask]
        equal = size == self.borders[at + 1] - self.borders[at]
        sums = np.concatenate(([0], np.cumsum(size)))
        lo = 0
        while lo < len(ask):
            hi = max(lo + 1, int(np.searchsorted(sums, sums[lo] + COMPARED_AT_ONCE, side="right")) - 1)
            part = lo + np.flatnonzero(equal[lo:hi])
            n = size[part]
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            differ = LOWER[data[np.repeat(words.start[ask[part]], n) + inner]] != self.data[
                np.repeat(self.borders[at[part]], n) + inner]
            if len(part):
                equal[part] = ~np.logical_or.reduceat(differ, np.cumsum(n) - n)
            lo = hi
        return equal

    def bags(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Words per text, and its vocabulary words as sorted pairs (place, occurrences) of four bytes each."""
        words = Words(data, borders, ALNUM)
        found = self.find(data, words)
        held = found >= 0
        size = max(1, self.size)
        cell, times = np.unique(words.owner()[held] * size + found[held], return_counts=True)
        ends = np.searchsorted(cell // size, np.arange(len(borders))) * 8
        pairs = np.stack((cell % size, times), axis=1).astype("<u4")
        bag = pa.Array.from_buffers(
            pa.binary(), len(borders) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(pairs.tobytes())])
        return words.count.astype(np.int64), bag


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and occurrences of every pair in a column of bags."""
    data, borders = flat(column)
    pairs = np.frombuffer(data.tobytes(), "<u4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(column)), np.diff(borders) // 8), pairs[:, 0], pairs[:, 1]


def item_blocks(items: DataFrame, id_col: str, text: str, limit: int) -> Iterator[list[tuple]]:
    """(id, text, how often it is there) of the items in blocks of about ``limit`` bytes, each fetched in its turn."""
    each = items.select(F.col(id_col).alias("i"), F.col(text).cast("string").alias("t")).where("t is not null")
    each = each.groupBy("i", "t").count()
    total = each.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    count = max(1, -(-total // limit))
    part = F.pmod(F.xxhash64("t"), F.lit(count))
    for k in range(count):
        yield sorted((tuple(r) for r in each.where(part == k).collect()), key=lambda r: (r[1], str(r[0])))


def class_hash(bag: Column, m: Column) -> Column:
    return F.xxhash64(bag, m)


def _classes(bags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, hashes shared by several): one row (h, k, m, bag, members, least) per distinct (m, bag).

    Rows are grouped by their hash; where the smallest and the largest (m, bag) of a hash agree, the class is verified
    and ``k`` is 0. The classes of a hash that several share are told apart by their bytes and numbered by ``k`` from 1.
    """
    same = F.struct("m", "bag")
    grouped = bags.groupBy("h").agg(
        F.min(same).alias("lo"), F.max(same).alias("hi"), F.count("*").alias("members"), F.min("doc_id").alias("least"))
    grouped = written(grouped, "bags-by-hash")
    single = grouped.where("lo = hi").select("h", F.lit(0).alias("k"), "lo.m", "lo.bag", "members", "least")
    shared = written(grouped.where("lo <> hi").select("h"), "shared-hashes")
    apart = bags.join(shared, "h", "left_semi").groupBy("h", "m", "bag").agg(
        F.count("*").alias("members"), F.min("doc_id").alias("least"))
    k = F.row_number().over(Window.partitionBy("h").orderBy("m", "bag"))
    return single.union(apart.select("h", k.alias("k"), "m", "bag", "members", "least")), shared


def _documents_with(classes: DataFrame, size: int) -> np.ndarray:
    """For every word of the vocabulary, the documents that hold it: summed per task, then per word."""

    def sums(batches):
        made = np.zeros(size, np.int64)
        for piece in pieces(batches, "bag"):
            row, term, _ = unpacked(piece.column("bag"))
            np.add.at(made, term, piece.column("members").to_numpy()[row])
        at = np.flatnonzero(made)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(made[at])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    counted = classes.select("bag", "members").mapInArrow(sums, "term bigint, df bigint")
    for term, df in counted.groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


class _Best:
    """The ``top`` best classes of every item that one task has seen: highest score, then smallest document."""

    def __init__(self, items: int, top: int):
        self.items, self.top = items, top
        self.rows = np.zeros((5, 0), np.int64)  # item, score, least, h, k
        self.bar = np.ones(items, np.int64)

    def add(self, rows: np.ndarray) -> None:
        self.rows = np.concatenate((self.rows, rows), axis=1)
        if self.rows.shape[1] > max(POOL, 4 * self.items * self.top):
            self.settle()

    def settle(self) -> None:
        item, score, least, h, k = self.rows
        order = np.lexsort((k, h, least, -score, item))
        sorted_items = item[order]
        rank = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items)
        self.rows = self.rows[:, order[rank < self.top]]
        last = order[rank == self.top - 1]
        self.bar[item[last]] = np.maximum(1, score[last])


def _scored(classes: DataFrame, words: Vocabulary, weight: np.ndarray, items: int, top: int) -> DataFrame:
    """(item, score, least, h, k): of every task, each item's ``top`` best classes of those it scored."""
    sent = classes.sparkSession.sparkContext.broadcast((words.first, words.item, words.times, weight))

    def run(batches):
        first, item, times, weight = sent.value
        best = _Best(items, top)
        for piece in pieces(batches, "bag"):
            row, term, tf = unpacked(piece.column("bag"))
            m = piece.column("m").to_numpy()
            gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
            least = piece.column("least").fill_null(LAST).to_numpy()
            h, k = (piece.column(c).to_numpy().astype(np.int64) for c in ("h", "k"))
            many = first[term + 1] - first[term]
            reach = np.concatenate(([0], np.cumsum(many)))
            edge = np.searchsorted(row, np.arange(len(m) + 1))
            lo = 0
            while lo < len(m):
                hi = int(np.searchsorted(reach[edge], reach[edge[lo]] + CELLS_AT_ONCE, side="right")) - 1
                hi = min(max(hi, lo + 1), lo + max(1, CELLS_AT_ONCE // max(1, items)))
                a, b = edge[lo], edge[hi]
                n = many[a:b]
                at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[term[a:b]], n)
                score = np.zeros((hi - lo) * items, np.int64)
                np.add.at(score, np.repeat((row[a:b] - lo) * items, n) + item[at], np.repeat(gain[a:b], n) * times[at])
                of, to = np.nonzero(score.reshape(hi - lo, items) >= best.bar)
                who = lo + of
                best.add(np.stack((to, score[of * items + to], least[who], h[who], k[who])))
                lo = hi
        best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.rows], names=["item", "score", "least", "h", "k"])

    return classes.select("h", "k", "m", "bag", "least").mapInArrow(
        run, "item bigint, score bigint, least bigint, h bigint, k bigint")


def _search_block(docs: DataFrame, items: list[tuple], kind: T.DataType, top: int) -> DataFrame:
    words = Vocabulary([t for _, t, _ in items])
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def compute(data, borders):
        n, bag = sent.value.bags(data, borders)
        return {"n": pa.array(n), "bag": bag}

    fields = [T.StructField("n", T.LongType(), False), T.StructField("bag", T.BinaryType(), False)]
    bags = written(with_text_columns(docs, "__t", compute, fields, ["doc_id"]), "bags")
    documents, length = bags.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    length_share = F.expr(f"cast(75 * cast(n as decimal(18,0)) * {documents}BD as decimal(38,0)) div {max(1, length)}BD")
    bags = bags.where("length(bag) > 0").select("doc_id", "bag", (25 + length_share).cast("long").alias("m"))
    bags = bags.withColumn("h", class_hash(F.col("bag"), F.col("m")))
    classes, shared = _classes(bags)
    df = _documents_with(classes, words.size)
    weight = np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * df + 1))).astype(np.int64)
    best = _scored(classes, words, weight, len(items), top)
    by_item = Window.partitionBy("item")
    rank = F.row_number().over(by_item.orderBy(F.desc("score"), "least", "h", "k"))
    best = written(best.withColumn("r", rank).where(F.col("r") <= top).drop("r", "least"), "best-classes")

    wanted = best.select("h", "k").distinct()
    members = bags.select("doc_id", "h").join(wanted.where("k = 0"), "h")
    several = classes.where("k > 0").join(wanted, ["h", "k"]).select("h", "m", "bag", "k")
    apart = bags.join(shared, "h", "left_semi").join(several, ["h", "m", "bag"]).select("h", "doc_id", "k")
    members = members.select("h", "doc_id", "k").union(apart)
    nth = F.row_number().over(Window.partitionBy("h", "k").orderBy(F.asc_nulls_last("doc_id")))
    members = members.withColumn("r", nth).where(F.col("r") <= top).drop("r")
    found = best.join(members, ["h", "k"])
    rank = F.row_number().over(by_item.orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    found = found.withColumn("rank", rank).where(F.col("rank") <= top)
    names = T.StructType([
        T.StructField("item", T.LongType()), T.StructField("item_id", kind), T.StructField("times", T.LongType())])
    named = docs.sparkSession.createDataFrame([(n, i, c) for n, (i, _, c) in enumerate(items)], names)
    named = named.withColumn("times", F.explode(F.expr("sequence(1L, times)")))
    return found.join(named, "item").select("item_id", "rank", "doc_id", "score")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``top`` highest-scoring documents with a score above 0.

    A document is cut down to the words that the items have: pairs of word and occurrences. Documents with the same
    pairs and the same length factor m score alike for every item, so they are one class: grouped by a hash, told apart
    by bytes where a hash is shared. Each class is scored once, in 64-bit integers, over the postings of its words; a
    task keeps ``top`` classes an item, ordered by score and then by their smallest document, which holds every document
    that can rank. Only the classes that win are expanded, by ascending doc_id, a null one last. However many rows share
    a class, its group sends one row per task.

    Items are a stated query set; a block of at most about ``block_bytes`` of them is broadcast (a single longer item
    shares a block), and every further block takes its turn over all documents. Null and empty texts have no words:
    they neither count nor rank. Ids of documents are integers; rows that share an id are documents of their own. Items
    without a word find nothing; repeated items each get their rows, items without an id too.
    """
    each = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("__t"))
    kind = items.schema[item_id].dataType
    found = [_search_block(each, block, kind, top) for block in item_blocks(items, item_id, item_text, block_bytes)]
    return reduce(DataFrame.union, found)
