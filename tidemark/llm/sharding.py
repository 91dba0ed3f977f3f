"""Sharding by histogram sort: shards of near equal bytes that are ranges of one key (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import written

KEY_BITS = 63
ID_BITS = 31
STEP_BITS = 9
ROW_BITS = 33


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def splitters(sized: DataFrame, shards: int, tolerance: float) -> tuple[list[int], list[int]]:
    """Keys that cut the bytes into ``shards`` near equal parts, and the bytes below each.

    Round by round, the bytes below candidate borders are counted exactly over all rows; the range in which a
    border must lie is cut into 2**STEP_BITS candidates for the next round. A range is settled once it weighs no
    more than ``tolerance`` of a shard or its key bits are used up. A round returns at most (shards - 1) * 2**STEP_BITS
    counts, whatever the table holds.
    """
    total = sized.agg(F.sum("size")).first()[0] or 0
    goals = [total * i // shards for i in range(1, shards)]
    open_ranges = {0: (0, total)}  # prefix: bytes before the range, bytes inside
    found: dict[int, tuple[int, int]] = {}
    bits = 0
    pending = {g: 0 for g in goals} if total else {}  # goal: prefix of the range it lies in
    while pending:
        step = min(STEP_BITS, KEY_BITS - bits)
        inside = F.shiftright("key", KEY_BITS - bits)
        rows = sized if bits == 0 else sized.where(inside.isin(sorted(set(pending.values()))))
        cell = F.shiftright("key", KEY_BITS - bits - step).alias("cell")
        counts = {r[0]: r[1] for r in rows.groupBy(cell).agg(F.sum("size")).collect()}
        bits += step
        ranges = {}
        for prefix in set(pending.values()):
            below = open_ranges[prefix][0]
            for cell_no in range(prefix << step, (prefix + 1) << step):
                if inside_bytes := counts.get(cell_no, 0):
                    ranges[cell_no] = (below, inside_bytes)
                    below += inside_bytes
        after = {}
        for goal, prefix in pending.items():
            of_prefix = [c for c in ranges if c >> step == prefix]
            cell_no = next(c for c in sorted(of_prefix) if goal < sum(ranges[c]))
            before, weight = ranges[cell_no]
            if weight <= tolerance * total / shards or bits == KEY_BITS:
                near_end = goal - before > weight / 2
                found[goal] = ((cell_no + near_end) << (KEY_BITS - bits), before + weight * near_end)
            else:
                after[goal] = cell_no
        pending, open_ranges = after, ranges
    return [found[g][0] for g in goals if g in found], [found[g][1] for g in goals if g in found]


def shard(
    docs: DataFrame,
    shards: int = 24,
    overhead: int = 8,
    tolerance: float = 0.04,
    keep: Sequence[str] = (),
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row with its shard and its slot in it.

    Returns ``keep`` columns plus doc_id, size (UTF-8 bytes plus ``overhead``), text_crc32, shard and slot (gapless
    from 0 in each shard). The key has the checksum of the text in its high bits and a hash of the id below, so equal
    texts are neighbours: a border falls between groups of equal texts while a group weighs no more than
    ``tolerance`` of a shard, and inside a heavier group, which so spreads over as many shards as its bytes need.
    Borders come from exact counts (``splitters``); then all rows move once, in one range exchange.

    Null text weighs ``overhead`` bytes and counts as empty for its checksum; rows with a null id keep a place by
    their text; repeated rows are rows of their own. With fewer rows than shards, some shards are empty. Kept
    columns of the same name as a result column give way to it.
    """
    made = ("doc_id", "size", "text_crc32", "shard", "slot")
    keep = [c for c in keep if c not in made]
    sized = docs.select(
        *keep,
        F.col(id_col).alias("doc_id"),
        (text_bytes(F.col(text)) + overhead).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    low = F.col("text_crc32").bitwiseAND((1 << 32) - 1)
    keyed = sized.withColumn(
        "key", F.shiftleft(low, ID_BITS).bitwiseOR(F.xxhash64("doc_id").bitwiseAND((1 << ID_BITS) - 1))
    )
    keyed = written(keyed, "keyed")
    cuts, _ = splitters(keyed.select("key", "size"), shards, tolerance)
    number = F.lit(0)
    for cut in cuts:
        # the last key of all may be the border itself, which no 63 bits can hold: then nothing lies above it
        number = number + ((F.col("key") >= F.lit(cut)) if cut < 1 << KEY_BITS else F.lit(False)).cast("int")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keyed.withColumn("shard", number)
    placed = placed.repartitionByRange(parts, "key", "doc_id").sortWithinPartitions("key", "doc_id")
    placed = written(placed.withColumn("__at", F.monotonically_increasing_id()), "sharded")
    placed = placed.withColumn("__part", F.shiftright("__at", ROW_BITS))
    firsts = placed.groupBy("shard", "__part").agg(F.count("*").alias("__rows"), F.min("__at").alias("__first"))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select(
        "shard", "__part", "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before")
    )
    firsts = written(firsts, "firsts")
    rows = placed.join(firsts, ["shard", "__part"])
    slot = F.col("__at") - F.col("__first") + F.col("__before")
    return rows.select(*keep, "doc_id", "size", "text_crc32", "shard", slot.alias("slot"))
