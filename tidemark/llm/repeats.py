"""Removal of byte strings that repeat anywhere in the corpus, by suffix arrays built in two stages."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import flat, pieces
from tidemark.plans.scratch import written

LENGTH = 400
GRAM = 64
#: bytes of text sorted at once in a task
CHUNK_BYTES = 1 << 20
#: starts of one anchor that one suffix array holds; anchors with more are settled start by start
ANCHOR_STARTS = 1 << 19
#: offsets from the anchor that stay together when a heavy anchor is split
BAND = 16
MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a multiple of 8) at every position that has so many."""
    n = len(text) - gram + 1
    eight = np.lib.stride_tricks.sliding_window_view(text, 8)
    words = np.ascontiguousarray(eight).view("<u8").ravel() * MIX
    words ^= words >> np.uint64(29)
    out = np.zeros(n, np.uint64)
    for k in range(0, gram, 8):
        out = (out * np.uint64(0xC2B2AE3D27D4EB4F)) ^ words[k : k + n]
        out *= MIX
    out ^= out >> np.uint64(32)
    return out * MIX


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1) - 1


def anchors_of(text: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(hash, first, last, at), (known first, known last) of a text.

    Every window of ``length`` bytes has one anchor, its least gram, the leftmost of equals; the windows that start at
    first..last share the one at ``at``. Equal windows have equal anchor hashes at equal distances. Where a short period
    repeats an anchor, windows that equal the one a period later are known repeats; that later one stands for them.
    """
    none = np.zeros(0, np.int64)
    if len(text) < length:
        return none.astype(np.uint64), none, none, none, none, none
    hashes = gram_hashes(text, gram)
    wide = length - gram + 1
    starts = len(text) - length + 1
    low = np.uint64((1 << (wide - 1).bit_length()) - 1)
    full = -(-len(hashes) // wide) * wide
    padded = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(hashes)] = hashes & ~low
    blocks = padded.reshape(-1, wide)
    blocks |= np.arange(wide, dtype=np.uint64)  # the low bits name the place of the gram within its block
    begins = np.repeat(np.arange(0, full, wide), wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()[wide - 1 : wide - 1 + starts]
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[:starts]
    # a window ends in the block it starts in or the next; of equals, the one in the first block is the leftmost
    before = behind <= (ahead | low)
    place = (np.where(before, behind, ahead) & low).view(np.int64)
    place += np.where(before, begins[:starts], begins[wide - 1 : wide - 1 + starts])
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.append(first[1:], starts) - 1
    at = place[first]
    codes = hashes[at]
    periodic = np.flatnonzero((codes[1:] == codes[:-1]) & (at[1:] > at[:-1]))
    if not len(periodic):
        return codes, first, last, at, none, none
    known = np.zeros(starts, bool)
    stands = np.ones(starts, bool)  # for itself
    for i in periodic.tolist():
        step, lo = int(at[i + 1] - at[i]), int(first[i])
        hi = min(int(last[i]), starts - 1 - step)
        if hi < lo:
            continue
        other = np.flatnonzero(text[lo : hi + length] != text[lo + step : hi + step + length])
        here = np.arange(hi - lo + 1)
        following = np.append(other, np.iinfo(np.int64).max)[np.searchsorted(other, here)]
        equal = lo + here[following - here >= length]
        known[equal] = known[equal + step] = True
        stands[equal] = False
    run = np.repeat(np.arange(len(first)), last - first + 1)
    new = stands & np.concatenate(([True], ~stands[:-1] | (run[1:] != run[:-1])))
    end = stands & np.concatenate((~stands[1:] | (run[1:] != run[:-1]), [True]))
    begin, finish = np.flatnonzero(new), np.flatnonzero(end)
    return codes[run[begin]], begin, finish, at[run[begin]], *_runs(known)


def helper_end(text: np.ndarray, last: int) -> int:
    """The first position after ``last`` whose suffix is smaller than its successor; the length of the text if none."""
    at = last + 1
    n = len(text)
    while at < n:
        part = text[at : at + 64].astype(np.int16)
        step = np.diff(part)
        up = np.flatnonzero(step)
        rises = up[step[up] > 0]
        if len(rises):
            # equal bytes before a rise belong to it
            k = int(rises[0])
            while k > 0 and part[k - 1] == part[k]:
                k -= 1
            return at + k
        if len(part) < 64:
            return n
        at += 63
    return n


def suffix_order(text: bytes, segments: list[tuple[int, int, int]], depth: int) -> list[int]:
    """Positions lo..hi of all segments (lo, hi, end) in the order of their next ``depth`` bytes.

    Two stages: suffixes smaller than their successor, and the last of a segment, which is one such or empty, are sorted
    directly; a suffix larger than its successor comes right after all that start with the same byte and were put
    before, so one scan from the smallest suffix on puts each into its byte's bucket.
    """
    raw = np.frombuffer(text, np.uint8)
    small = np.zeros(len(raw) + 1, bool)
    inside = np.zeros(len(raw) + 1, bool)
    for lo, hi, _ in segments:
        # type of each position: by the next byte that differs, up to the last, which is sorted directly
        part = raw[lo : hi + 1].astype(np.int16)
        step = np.diff(part)
        kind = np.ones(hi - lo + 1, bool)
        if len(step):
            at = np.where(step != 0, np.arange(len(step)), len(step))
            nxt = np.minimum.accumulate(at[::-1])[::-1]
            # a run of equal bytes up to the last position has the type of the last
            kind[:-1] = np.where(nxt < len(step), step[np.minimum(nxt, len(step) - 1)] > 0, True)
        small[lo : hi + 1] = kind
        inside[lo : hi + 1] = True
    ends = {hi: end for _, hi, end in segments}
    direct = np.flatnonzero(small & inside).tolist()
    limit = {hi: end for hi, end in ends.items()}
    owner_end = np.zeros(len(raw) + 1, np.int64)
    for lo, hi, end in segments:
        owner_end[lo : hi + 1] = end
    stops = owner_end[direct].tolist()
    direct = [p for _, p in sorted(zip([text[p : min(p + depth, e)] for p, e in zip(direct, stops)], direct))]
    larger = (inside & ~small).tolist()
    # buckets: larger ones of a byte first, directly sorted ones after them
    heads: list[list[int]] = [[] for _ in range(256)]
    tails: list[list[int]] = [[] for _ in range(256)]
    empty = []
    for p in direct:
        if p in limit and limit[p] == p:
            empty.append(p)  # the empty suffix at the end of a text
        else:
            tails[text[p]].append(p)
    out: list[int] = []
    for p in empty:
        out.append(p)
        if p and larger[p - 1]:
            heads[text[p - 1]].append(p - 1)
    for byte in range(256):
        head = heads[byte]
        i = 0
        while i < len(head):  # grows while it is scanned
            p = head[i]
            i += 1
            out.append(p)
            if p and larger[p - 1]:
                heads[text[p - 1]].append(p - 1)
        for p in tails[byte]:
            out.append(p)
            if p and larger[p - 1]:
                heads[text[p - 1]].append(p - 1)
    return out


def repeated_starts(parts: list[tuple[bytes, int, int]], length: int) -> list[np.ndarray]:
    """For each part (bytes, number of starts, place of its helper suffix): flags of the starts whose next ``length``
    bytes also start elsewhere among the starts of all parts."""
    segments, base = [], []
    at = 0
    for text, _, helper in parts:
        segments.append((at, at + helper, at + len(text)))
        base.append(at)
        at += len(text) + 1
    whole = b"\0".join(p[0] for p in parts) + b"\0"
    real = np.zeros(len(whole) + 1, bool)
    for b, (_, starts, _) in zip(base, parts):
        real[b : b + starts] = True
    order = suffix_order(whole, segments, length)
    order = [p for p in order if real[p]]
    flags = np.zeros(len(whole) + 1, bool)
    # common prefixes of neighbours: only whether they reach ``length``
    for p, q in zip(order[:-1], order[1:]):
        if whole[p : p + length] == whole[q : q + length]:
            flags[p] = flags[q] = True
    return [flags[b : b + starts] for b, (_, starts, _) in zip(base, parts)]


def _find_anchors(length: int, gram: int):
    def run(batches):
        for batch in pieces(batches, "t"):
            data, borders = flat(batch.column("t"))
            columns, counts = [], []
            for a, b in zip(borders[:-1], borders[1:]):
                code, first, last, at, lo, hi = anchors_of(data[a:b], length, gram)
                known = np.arange(len(code) + len(lo)) >= len(code)
                zero = np.zeros(len(lo), np.int64)
                columns.append((np.append(code.view(np.int64), zero), np.append(first, lo), np.append(last, hi),
                                np.append(at, zero), known))
                counts.append(len(known))
            code, first, last, at, known = (np.concatenate(c) for c in zip(*columns))
            nth = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(nth), *map(pa.array, (code, first, last, at, known))],
                names=["key", "anchor", "first", "last", "at", "known"])

    return run


def _piece(text: np.ndarray, first: int, last: int, at: int, length: int) -> tuple:
    """(starts, helper, at, same, piece) of the windows that start at first..last."""
    helper = helper_end(text, last)
    piece = text[first : helper + length].tobytes()
    # equal windows in equal order at equal distance from the anchor: the bytes that the starts cover
    same = xxhash.xxh128_digest(piece[: last - first + length] + (at - first).to_bytes(8, "little"))
    return last - first + 1, helper - first, at - first, same, piece


PIECE = "starts int, helper int, at int, same binary, piece binary"
PIECE_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]


def _batches_of(rows, names: list[str], kinds: list[pa.DataType]):
    """Record batches of a few megabytes from rows whose last value is a piece."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[-1])
        if weight > 4 * CHUNK_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def _cut(length: int):
    """Rows with the text around each anchor: the windows' bytes and up to the helper suffix with as many again."""

    def rows(batches):
        for batch in pieces(batches, "t"):
            data, borders = flat(batch.column("t"))
            for key, wanted, a, b in zip(
                batch.column("key").to_pylist(), batch.column("anchors").to_pylist(), borders[:-1], borders[1:]
            ):
                for one in wanted:
                    made = _piece(data[a:b], one["first"], one["last"], one["at"], length)
                    yield key, one["anchor"], one["first"], *made

    names = ["key", "anchor", "first", "starts", "helper", "at", "same", "piece"]
    return lambda batches: _batches_of(rows(batches), names, [pa.binary(), pa.int64(), pa.int64(), *PIECE_TYPES])


def _bands(length: int):
    """Each piece in parts of at most BAND distances from the anchor, under names of their own."""

    def rows(batches):
        for batch in batches:
            for anchor, same, starts, at, piece in zip(
                *(batch.column(c).to_pylist() for c in ("anchor", "same", "starts", "at", "piece"))
            ):
                text = np.frombuffer(piece, np.uint8)
                lo = 0
                while lo < starts:
                    band = (at - lo) // BAND
                    hi = min(starts - 1, at - band * BAND)
                    name = xxhash.xxh64_intdigest(f"{anchor} {band}") - (1 << 63)
                    yield anchor, same, lo, name, *_piece(text, lo, hi, at, length)
                    lo = hi + 1

    names = ["anchor0", "same0", "lo0", "anchor", "starts", "helper", "at", "same", "piece"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), *PIECE_TYPES]
    return lambda batches: _batches_of(rows(batches), names, kinds)


def _sort(length: int):
    """Rows sorted by anchor: suffix arrays over whole anchors, up to CHUNK_BYTES at once."""

    def settle(rows):
        flags = repeated_starts([(r[3], r[1], r[2]) for r in rows], length)
        same, lo, hi = [], [], []
        for row, flag in zip(rows, flags):
            a, b = _runs(flag)
            same.extend([row[0]] * len(a))
            lo.extend(a.tolist())
            hi.extend(b.tolist())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in same], pa.int64()), pa.array([r[1] for r in same], pa.binary()),
             pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], names=["anchor", "same", "lo", "hi"])

    def run(batches):
        rows, weight = [], 0
        current = None
        for batch in batches:
            for anchor, same, starts, helper, piece in zip(*(batch.column(c).to_pylist() for c in (
                    "anchor", "same", "starts", "helper", "piece"))):
                if anchor != current and weight >= CHUNK_BYTES:
                    yield settle(rows)
                    rows, weight = [], 0
                current = anchor
                rows.append(((anchor, same), starts, helper, piece))
                weight += len(piece)
        if rows:
            yield settle(rows)

    return run


def _windows(length: int):
    """One row per start: 128 bits of the hash of its window."""

    def run(batches):
        for batch in batches:
            for anchor, same, starts, piece in zip(*(batch.column(c).to_pylist() for c in (
                    "anchor", "same", "starts", "piece"))):
                codes = [xxhash.xxh128_digest(piece[s : s + length]) for s in range(starts)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([anchor] * starts, pa.int64()), pa.array([same] * starts, pa.binary()),
                    pa.array(np.arange(starts)), pa.array(codes, pa.binary()),
                ], names=["anchor", "same", "lo", "window"])

    return run


def _remaining(length: int):
    def run(batches):
        for batch in pieces(batches, "t"):
            data, borders = flat(batch.column("t"))
            removed, runs, shas = [], [], []
            for spans, a, b in zip(batch.column("spans").to_pylist(), borders[:-1], borders[1:]):
                text = data[a:b]
                change = np.zeros(len(text) + 1, np.int32)
                first = np.array([s["first"] for s in spans], np.int64)
                last = np.array([s["last"] for s in spans], np.int64)
                np.add.at(change, first, 1)
                np.add.at(change, last + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                removed.append(int(gone.sum()))
                runs.append(len(_runs(gone)[0]))
                shas.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                pa.array(shas, pa.string()),
            ], names=["key", "n_removed", "n_spans", "kept_sha256"])

    return run


def settled(cut: DataFrame, place: list[str], length: int, split: bool = True) -> DataFrame:
    """(anchor, same, lo, hi): runs of repeated starts in the pieces of ``cut``, numbered within the piece; hi is -1 for
    all starts. ``place`` names a piece's origin. Equal pieces repeat as a whole, and one of them goes on."""
    alike = written(cut.groupBy("anchor", "same").agg(
        F.count_distinct(*place).alias("n"), F.min(F.struct(*place)).alias("from"), F.min("starts").alias("starts")
    ), "alike")
    whole = alike.where("n > 1").select(
        "anchor", "same", F.lit(0).cast("long").alias("lo"), F.lit(-1).cast("long").alias("hi")
    )
    weight = alike.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("starts").alias("weight"))
    # written, so that the join has two plain sides and Spark may split an anchor with very many kinds
    weight = written(weight.where("kinds > 1").select("anchor", "weight"), "weights")
    ones = alike.join(weight, "anchor").select("anchor", "same", "from.*", "weight")
    ones = cut.join(ones, ["anchor", "same", *place]).dropDuplicates(["anchor", "same"])
    ones = written(ones.select("anchor", "same", "starts", "helper", "at", "piece", "weight"), "kinds")
    light = ones.where(F.col("weight") <= ANCHOR_STARTS).drop("weight", "at")
    light = light.repartition("anchor").sortWithinPartitions("anchor", "same")
    runs = light.mapInArrow(_sort(length), "anchor bigint, same binary, lo bigint, hi bigint")
    heavy = ones.where(F.col("weight") > ANCHOR_STARTS)
    if split:
        bands = written(heavy.select("anchor", "same", "starts", "at", "piece").mapInArrow(
            _bands(length), f"anchor0 bigint, same0 binary, lo0 bigint, anchor bigint, {PIECE}"
        ), "bands")
        inner = settled(bands, ["anchor0", "same0", "lo0"], length, split=False)
        more = bands.select("anchor0", "same0", "lo0", "anchor", "same", "starts").join(inner, ["anchor", "same"])
        end = F.when(F.col("hi") < 0, F.col("starts") - 1).otherwise(F.col("hi"))
        more = more.select(F.col("anchor0").alias("anchor"), F.col("same0").alias("same"),
                           (F.col("lo0") + F.col("lo")).alias("lo"), (F.col("lo0") + end).alias("hi"))
    else:
        each = heavy.select("anchor", "same", "starts", "piece").mapInArrow(
            _windows(length), "anchor bigint, same binary, lo bigint, window binary"
        )
        often = each.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
        more = each.join(often, "window").select("anchor", "same", "lo", F.col("lo").alias("hi"))
    return runs.union(more).union(whole)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same text or another.

    1. Texts are named by their digest. A text that stands in several rows goes whole (if it has ``length`` bytes); one
       copy stands for all in what follows.
    2. Every window of ``length`` bytes belongs to one anchor, its least gram by hash, so equal windows belong to equal
       anchors. Anchors that occur once, about all in clean text, end here: 36 bytes a row, one row per about 170 bytes.
       In a stretch with a short period, windows that equal the one a period on are settled at once.
    3. The neighbourhoods of the other anchors are cut out of the texts. Equal neighbourhoods are repeats as a whole and
       one of them goes on, so a passage that a third of all texts share is one row, apart from its borders.
    4. Tasks take whole anchors, sort the suffixes of their neighbourhoods in two stages and compare neighbours. An
       anchor with more than ANCHOR_STARTS starts is split by distance from the anchor, which equal windows share; a
       part that is still heavier is settled by counts of the hashes of its windows.
    5. Starts found go back to all equal neighbourhoods, and by text to the bytes they cover.

    Null and empty texts have 0 bytes and nothing to remove. Rows with a null or repeated id are rows like any other.
    """
    digest = lambda c: F.unhex(F.substring(F.sha2(c.cast("binary"), 256), 1, 32))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("key", digest(F.col("t")))
    heads = written(rows.select(
        "doc_id", "key", F.octet_length("t").cast("long").alias("n_bytes"), F.sha2(F.col("t").cast("binary"), 256).alias("sha")
    ), "heads")
    long_heads = heads.where(F.col("n_bytes") >= length)
    copies = written(long_heads.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("one")), "copies")

    long_rows = rows.where(F.octet_length("t") >= length)
    found = written(long_rows.select("key", "t").mapInArrow(
        _find_anchors(length, gram),
        "key binary, anchor bigint, first bigint, last bigint, at bigint, known boolean",
    ), "anchors")
    place = F.xxhash64("key", "first")
    open_anchors = found.where("not known")
    twice = open_anchors.groupBy("anchor").agg(F.min(place).alias("p"), F.max(place).alias("q"))
    shared = open_anchors.join(twice.where("p <> q").select("anchor"), "anchor")
    shared = shared.withColumn("one", F.struct("anchor", "first", "last", "at"))
    shared = shared.select("key", "one", F.lit(None).cast("struct<first:bigint,last:bigint>").alias("known"))
    shared = shared.union(found.where("known").select(
        "key", F.lit(None).cast(shared.schema["one"].dataType), F.struct("first", "last")
    ))
    shared = shared.groupBy("key").agg(F.collect_set("one").alias("anchors"), F.collect_set("known").alias("known"))
    shared = written(shared.join(copies.select("key", "one"), "key"), "shared")

    source = long_rows.withColumnRenamed("key", "k")
    same_row = (source["k"] == shared["key"]) & source["doc_id"].eqNullSafe(shared["one"])
    texts = source.join(shared, same_row).select("key", "anchors", "known", "t")
    texts = written(texts, "texts")
    cut = written(texts.select("key", "anchors", "t").mapInArrow(
        _cut(length), f"key binary, anchor bigint, first bigint, {PIECE}"
    ), "pieces")
    runs = written(settled(cut, ["key", "first"], length), "runs")
    spans = cut.select("key", "anchor", "same", "first", "starts").distinct().join(runs, ["anchor", "same"])
    last = F.when(F.col("hi") < 0, F.col("starts") - 1).otherwise(F.col("hi"))
    spans = spans.groupBy("key").agg(F.collect_list(F.struct(
        (F.col("first") + F.col("lo")).alias("first"), (F.col("first") + last).alias("last"))).alias("spans"))
    done = texts.select("key", "t", "known").join(spans, "key", "left")
    done = done.withColumn("spans", F.concat("known", F.coalesce("spans", F.array().cast(done.schema["known"].dataType))))
    done = done.select("key", "t", "spans").mapInArrow(
        _remaining(length), "key binary, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
    done = written(done.dropDuplicates(["key"]), "removed")
    whole = copies.where("n > 1").select("key", F.lit(True).alias("all"))
    # one row per text, written: the join with all rows has two plain sides too, so Spark may split a text's many copies
    out = heads.join(written(done.join(whole, "key", "full"), "outcomes"), "key", "left")
    gone = F.coalesce("all", F.lit(False))
    return out.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(gone, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
