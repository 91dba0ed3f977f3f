"""Benchmark decontamination: Wu-Manber search for word windows of test items in whole documents."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import ALNUM, LOWER, Words, mixed, with_text_columns
from tidemark.plans.scratch import written

TABLE_BITS = 18
SEGMENT_WORDS = 512
#: benchmark bytes that one pass searches for: a task holds their windows, about 50 times as much memory
BLOCK_BYTES = 4 << 20
STEP = np.uint64(0xA24BAED4963EE407)


def windows_of(items: Sequence[tuple[str | None, str]], width: int) -> dict[int, dict[bytes, list[int]]]:
    """By length in words: every window (lower-cased words with a blank between) and the items it comes from."""
    out: dict[int, dict[bytes, list[int]]] = {}
    for number, (_, text) in enumerate(items):
        data = np.frombuffer(text.encode(), np.uint8)
        words = Words(data, np.array([0, len(data)]), ALNUM, hashes=False)
        low = LOWER[data].tobytes()
        plain = [low[a:b] for a, b in zip(words.start.tolist(), words.end.tolist())]
        size = min(width, len(plain))
        for k in range(len(plain) - size + 1 if size else 0):
            owners = out.setdefault(size, {}).setdefault(b" ".join(plain[k : k + size]), [])
            if not owners or owners[-1] != number:
                owners.append(number)
    return out


def joined_hash(hashes: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words that end at each of ``last``."""
    out = np.zeros(len(last), np.uint64)
    for back in range(size):
        out = out * STEP + hashes[last - back]
    return mixed(out)


class WuManber:
    """Windows of one length. ``block`` words decide how far the search may jump; where it may not, the block's bucket,
    then the hash of the whole window and at last its bytes decide."""

    def __init__(self, size: int, patterns: dict[bytes, list[int]]):
        self.size, self.block = size, min(2, size)
        self.patterns = patterns
        text = [p + b" " for p in patterns]
        data = np.frombuffer(b"".join(text), np.uint8)
        words = Words(data, np.array([0, len(data)]), ALNUM)
        ends = np.arange(len(text)) * size + size - 1
        self.shift = np.full(1 << TABLE_BITS, size - self.block + 1, np.int64)
        for back in range(size - self.block, -1, -1):
            self.shift[self.slot(joined_hash(words.hash, ends - back, self.block))] = back
        self.buckets = np.unique(joined_hash(words.hash, ends, self.block))
        whole = joined_hash(words.hash, ends, size)
        order = np.argsort(whole)
        self.whole, self.names = whole[order], [list(patterns)[i] for i in order]

    @staticmethod
    def slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    @staticmethod
    def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
        return ordered[at] == values

    def ends(self, words: Words) -> np.ndarray:
        """Last words of windows whose hash is a pattern's. All segments of all texts are searched side by side."""
        first, last = words.bounds[:-1] + self.size - 1, words.bounds[1:]
        many = np.maximum(-(-(last - first) // SEGMENT_WORDS), 0)
        nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        at = np.repeat(first, many) + nth * SEGMENT_WORDS
        stop = np.minimum(at + SEGMENT_WORDS, np.repeat(last, many))
        found = []
        while len(at):
            blocks = joined_hash(words.hash, at, self.block)
            jump = self.shift[self.slot(blocks)]
            here = jump == 0
            if here.any():
                some = at[here][self.among(blocks[here], self.buckets)]
                some = some[self.among(joined_hash(words.hash, some, self.size), self.whole)]
                found.append(some)
            at = at + np.maximum(jump, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def search(self, data: np.ndarray, words: Words) -> list[tuple[int, bytes]]:
        """(first word, window) of every occurrence, by comparing bytes."""
        out = []
        ends = self.ends(words)
        for last, code in zip(ends.tolist(), joined_hash(words.hash, ends, self.size)):
            first = last - self.size + 1
            lo, hi = words.start[first], words.end[last]
            low = LOWER[data[lo:hi]].tobytes()
            spans = zip((words.start[first : last + 1] - lo).tolist(), (words.end[first : last + 1] - lo).tolist())
            text = b" ".join([low[a:b] for a, b in spans])
            k = int(np.searchsorted(self.whole, code))
            while k < len(self.whole) and self.whole[k] == code:
                if self.names[k] == text:
                    out.append((first, text))
                    break
                k += 1
        return out


#: the searchers of the last block that a Python worker has seen
_ready: dict[str, tuple[list[str | None], list[WuManber]]] = {}


def _searchers(key: str, sent: Broadcast, width: int) -> tuple[list[str | None], list[WuManber]]:
    if key not in _ready:
        items = sent.value
        _ready.clear()
        _ready[key] = [i for i, _ in items], [WuManber(size, found) for size, found in windows_of(items, width).items()]
    return _ready[key]


def item_blocks(
    benchmark: DataFrame, id_col: str, text: str, limit: int, unnamed: bool = False
) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of about ``limit`` bytes, each fetched when its turn comes and at least one in all; null
    texts drop out, null ids unless ``unnamed``. A single longer item is a block of its own or shares one."""
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text).alias("t"))
    items = items.where("t is not null" if unnamed else "i is not null and t is not null").distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    count = max(1, -(-total // limit))
    part = F.pmod(F.xxhash64("t"), F.lit(count))
    for k in range(count):
        yield [(r.i, r.t) for r in items.where(part == k).orderBy("i", "t").collect()]


FOUND = [
    T.StructField("n_words", T.LongType(), False),
    T.StructField("hit_spans", T.ArrayType(T.StructType([
        T.StructField("first", T.LongType()), T.StructField("end", T.LongType()),
    ])), False),
    T.StructField("item_ids", T.ArrayType(T.StringType()), False),
]


def search_block(
    docs: DataFrame, items: Sequence[tuple[str | None, str]], width: int, keep: Sequence[str], text: str
) -> DataFrame:
    """``keep`` columns plus n_words, hit_spans and item_ids for the windows of one block of items."""
    sent, key = docs.sparkSession.sparkContext.broadcast(list(items)), uuid.uuid4().hex

    def compute(data, borders):
        ids, searchers = _searchers(key, sent, width)
        words = Words(data, borders, ALNUM)
        change = np.zeros(len(words.start) + 1, np.int64)
        hit_items: dict[int, set[str]] = {}
        for one in searchers:
            hits = one.search(data, words)
            if not hits:
                continue
            first = np.array([h[0] for h in hits])
            np.add.at(change, first, 1)
            np.add.at(change, first + one.size, -1)
            owner = np.searchsorted(words.bounds, first, side="right") - 1
            for doc, (_, window) in zip(owner.tolist(), hits):
                hit_items.setdefault(doc, set()).update(ids[i] for i in one.patterns[window] if ids[i] is not None)
        inside = np.cumsum(change)[:-1] > 0
        # runs of hit words; a run ends with its document
        edge = np.zeros(len(inside) + 1, bool)
        edge[words.bounds] = True
        before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
        after = np.concatenate((inside[1:], [False])) & ~edge[1:]
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        owner = np.searchsorted(words.bounds, starts, side="right") - 1
        base = words.bounds[owner]
        spans = pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], names=["first", "end"])
        docs_at = np.searchsorted(owner, np.arange(len(borders))).astype(np.int32)
        return {
            "n_words": pa.array(words.count.astype(np.int64)),
            "hit_spans": pa.ListArray.from_arrays(pa.array(docs_at), spans),
            "item_ids": pa.array(
                [sorted(hit_items.get(d, ())) for d in range(len(borders) - 1)], pa.list_(pa.string())
            ),
        }

    return with_text_columns(docs, text, compute, FOUND, keep)


def merged_hits(hits: DataFrame, key: str) -> DataFrame:
    """One row per text with the runs that its ``hit_spans`` rows cover together and all their items."""
    spans = hits.select(key, F.inline("hit_spans"))
    by_first = Window.partitionBy(key).orderBy("first", "end")  # the spans of one text
    reach = F.max("end").over(by_first.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("__new", F.coalesce((F.col("first") > reach).cast("int"), F.lit(1)))
    spans = spans.withColumn("__run", F.sum("__new").over(by_first.rowsBetween(Window.unboundedPreceding, 0)))
    runs = spans.groupBy(key, "__run").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    runs = runs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("first", "end"))).alias("hit_spans"))
    ids = hits.select(key, F.explode_outer("item_ids").alias("i")).groupBy(key)
    return runs.join(ids.agg(F.array_sort(F.collect_set("i")).alias("item_ids")), key)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    unnamed: bool = False,
) -> DataFrame:
    """``keep`` columns plus n_words, hit_spans and item_ids for every document.

    hit_spans holds the runs [first, end) of words inside an occurrence of some window of ``width`` consecutive words of
    an item (an item of fewer words is one window); item_ids the items with an occurring window, sorted as strings.

    Items are a stated query set: a block of at most about ``block_bytes`` of them is broadcast, and the documents are
    searched where they are read, without a shuffle. Where the benchmark is larger, its blocks take their turn: each is
    searched in a pass of its own, of which only the texts with hits are written, so neither the driver nor a task ever
    holds two blocks; at the end the hits go back to the documents by the text's SHA-256. Every window is searched in
    every document at any size.

    Null and empty texts have no words and no hits; an empty benchmark hits nothing; items without words are left out;
    items without id too unless ``unnamed``, when their windows count in hit_spans and only item_ids goes without them;
    repeated items count once. Kept columns of the same name as a result column give way to it.
    """
    made = [f.name for f in FOUND]
    keep = [c for c in keep if c not in made]
    blocks = item_blocks(benchmark, item_id, item_text, block_bytes, unnamed)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return search_block(docs, first, width, keep, text)
    digest = F.sha2(F.col(text).cast("binary"), 256).alias("__sha")
    texts = docs.where(F.col(text).isNotNull()).select(digest, F.col(text).alias("__t"))
    hits = None
    for number, block in enumerate(chain([first, second], blocks)):
        found = search_block(texts, block, width, ["__sha"], "__t").where(F.size("hit_spans") > 0)
        found = written(found.select("__sha", "hit_spans", "item_ids").dropDuplicates(["__sha"]), f"hits-{number}")
        hits = found if hits is None else hits.union(found)
    hits = written(merged_hits(hits, "__sha"), "hits")
    each = search_block(docs.select("*", digest), [], width, [*keep, "__sha"], text).drop("hit_spans", "item_ids")
    none = lambda name: F.coalesce(name, F.array().cast(hits.schema[name].dataType)).alias(name)
    return each.join(hits, "__sha", "left").select(*keep, "n_words", none("hit_spans"), none("item_ids"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of a benchmark item occurs, with their own columns."""
    names = {c: f"__doc{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    found = contamination(inner, benchmark, keep=list(names.values()), text=names["text"], **options)
    return found.where(F.size("hit_spans") == 0).select(*[F.col(n).alias(c) for c, n in names.items()])
