"""Toxicity: class-conditional Kneser-Ney models of how words are spelled, over shared backoff counts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import ALNUM, LOWER, Words, flat, pieces, with_text_columns
from tidemark.llm.quality import fold, isotonic
from tidemark.plans.scratch import written

ORDER = 6
DISCOUNT = 0.75
#: an expression is kept apart for the classes if its shares differ by more than this factor, beyond chance
FACTOR = 2.0
CHANCE = 10.0
FOLDS = 4
HELD = 2
#: words added to every length, so that a few words do not decide as much as many
PRIOR_WORDS = 100
BINS = 4000
BLOCK_BYTES = 32 << 20
ENTRY_BYTES = 64
#: labelled texts up to this number are sent to where the texts are; more are met by a shuffle
SENT_LABELS = 1 << 21
#: models: learned from the texts of half 1, of half 0, and from all
MODELS = 3
COUNTS = ("o0", "o1", "t0", "t1")


def spelled(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, place, key) of every letter of words between blanks, the end blank included.

    ``key`` packs the letter and the up to ORDER - 1 bytes before it, never beyond the blank in front of the word, so
    shorter keys begin with that blank and differ from all longer ones. Nothing is hashed.
    """
    border = np.concatenate(([0], np.cumsum(size + 2)))
    word = np.repeat(np.arange(len(size)), size + 2)
    place = np.arange(border[-1]) - border[word]
    letters = np.full(border[-1], 32, np.uint64)
    inside = (place > 0) & (place <= size[word])
    letters[inside] = LOWER[data[start[word[inside]] + place[inside] - 1]]
    at = np.flatnonzero(place > 0)
    key = np.zeros(len(at), np.int64)
    for back in range(ORDER):
        some = place[at] >= back
        key[some] |= (letters[at[some] - back] << np.uint64(8 * back)).astype(np.int64)
    return word[at], place[at], key


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, o0, o1, t0, t1) from rows (text, kind): in how many texts of each kind a word is, lower-cased."""

    def run(batches):
        for piece in pieces(batches, "text"):
            data, borders = flat(piece.column("text"))
            words = Words(data, borders, ALNUM)
            if not len(words.start):
                continue
            owner = words.owner()
            order = np.lexsort((words.hash, owner))
            new = np.ones(len(order), bool)
            new[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (owner[order][1:] != owner[order][:-1])
            once = order[new]
            kinds, first, of = np.unique(words.hash[once], return_index=True, return_inverse=True)
            kind = piece.column("kind").to_numpy()[owner[once]]
            counts = [np.bincount(of[kind == c], minlength=len(kinds)) for c in range(len(COUNTS))]
            shown = once[first]
            size = words.end[shown] - words.start[shown]
            ends = np.concatenate(([0], np.cumsum(size)))
            inner = np.arange(ends[-1]) - np.repeat(ends[:-1], size)
            letters = LOWER[data[np.repeat(words.start[shown], size) + inner]]
            named = pa.Array.from_buffers(
                pa.binary(), len(size), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(letters.tobytes())])
            yield pa.RecordBatch.from_arrays([named, *map(pa.array, counts)], names=["word", *COUNTS])

    made = texts.select("text", "kind").mapInArrow(run, "word binary, o0 bigint, o1 bigint, t0 bigint, t1 bigint")
    return made.groupBy("word").agg(*[F.sum(c).alias(c) for c in COUNTS])


def expressions(words: DataFrame) -> DataFrame:
    """(gram, o0, o1, t0, t1): how often each letter follows its longest context, over the distinct words of texts."""

    def run(batches):
        for piece in pieces(batches, "word"):
            data, borders = flat(piece.column("word"))
            word, _, key = spelled(data, borders[:-1], np.diff(borders))
            grams, of = np.unique(key, return_inverse=True)
            counts = []
            for c in COUNTS:
                total = np.zeros(len(grams), np.int64)
                np.add.at(total, of, piece.column(c).to_numpy()[word])
                counts.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([pa.array(grams), *counts], names=["gram", *COUNTS])

    made = words.mapInArrow(run, "gram bigint, o0 bigint, o1 bigint, t0 bigint, t1 bigint")
    return made.groupBy("gram").agg(*[F.sum(c).alias(c) for c in COUNTS])


def _length(gram: Column) -> Column:
    """Bytes of a packed expression."""
    return sum(((F.shiftright(gram, 8 * n) > 0).cast("int") for n in range(ORDER)), F.lit(0))


def _beyond(a: Column, b: Column, all_a: Column, all_b: Column) -> Column:
    """Likelihood ratio (twice its logarithm) of the counts against a share in ``a`` of FACTOR times that in ``b``."""
    share = F.try_divide(all_a * FACTOR, all_a * FACTOR + all_b)
    want_a, want_b = (a + b) * share, (a + b) * (1 - share)
    part = lambda n, want: F.when(n > 0, n * F.log(F.try_divide(n.cast("double"), want))).otherwise(0.0)
    return F.when(a > want_a, 2 * (part(a, want_a) + part(b, want_b))).otherwise(0.0)


def kept_expressions(grams: DataFrame) -> DataFrame:
    """(gram, llr0, llr1, llr2): the expressions whose Kneser-Ney probabilities differ between the classes beyond chance,
    in the models learned from the texts of half 1, of half 0 and from all; null where they do not.

    The longest contexts use counts, shorter ones the number of different bytes in front (Kneser-Ney); contexts that
    begin with a word have nothing in front and keep their counts. Each order takes DISCOUNT off every count and hands it
    to the next shorter context; the shortest backs off to one table of both classes together. An expression that is
    too rare to tell the classes apart is left to its shorter contexts, at the end to the shared counts, where the
    classes do not differ. One row per context and byte, never more than 256 a context, is ordered in one task.
    """
    from_halves = {"o0": "o1", "t0": "t1", "o1": "o0", "t1": "t0", "o2": "o0 + o1", "t2": "t0 + t1"}
    counts = list(from_halves)
    raw = grams.select("gram", *[F.expr(x).alias(c) for c, x in from_halves.items()], _length(F.col("gram")).alias("n"))
    levels = {}
    for n in range(ORDER, 0, -1):
        level = raw.where(F.col("n") == n).select("gram", *counts)
        if n < ORDER:
            shorter = F.col("gram").bitwiseAND((1 << 8 * n) - 1).alias("gram")
            longer = levels[n + 1].select(shorter, *[(F.col(c) > 0).cast("long").alias(c) for c in counts])
            level = level.union(longer).groupBy("gram").agg(*[F.sum(c).alias(c) for c in counts])
        levels[n] = written(level, f"level-{n}")
    below = kept = None
    for n in range(1, ORDER + 1):
        context = Window.partitionBy(F.shiftright("gram", 8))
        level = levels[n].withColumns({f"all_{c}": F.sum(c).over(context) for c in counts})
        level = level.withColumns({f"kinds_{c}": F.sum((F.col(c) > 0).cast("long")).over(context) for c in counts})
        if n > 1:
            level = level.withColumn("shorter", F.col("gram").bitwiseAND((1 << 8 * (n - 1)) - 1)).join(below, "shorter")
        made = {}
        for m in range(MODELS):
            o, t = F.col(f"o{m}"), F.col(f"t{m}")
            all_o, all_t = F.col(f"all_o{m}").cast("double"), F.col(f"all_t{m}").cast("double")
            shared = F.try_divide((o + t).cast("double"), all_o + all_t)

            def smoothed(c, every):
                back = F.col(f"back_{c}") if n > 1 else shared
                kept_back = F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(f"kinds_{c}") * back
                return F.coalesce(F.try_divide(kept_back, every), back)

            made[f"p_o{m}"], made[f"p_t{m}"] = smoothed(f"o{m}", all_o), smoothed(f"t{m}", all_t)
            apart = F.greatest(_beyond(t, o, all_t, all_o), _beyond(o, t, all_o, all_t)) > CHANCE
            apart = apart & (all_t > 0) & (all_o > 0) & F.lit(n > 1)
            made[f"llr{m}"] = F.when(apart, F.log(F.col(f"p_t{m}") / F.col(f"p_o{m}")))
        level = level.withColumns({c: x for c, x in made.items() if c[0] == "p"})
        level = level.withColumns({c: x for c, x in made.items() if c[0] == "l"})
        level = written(level.select("gram", *made), f"smoothed-{n}")
        below = level.select(F.col("gram").alias("shorter"), *[F.col(f"p_{c}").alias(f"back_{c}") for c in counts])
        ratios = [f"llr{m}" for m in range(MODELS)]
        some = level.where(F.coalesce(*ratios).isNotNull()).select("gram", *ratios)
        kept = some if kept is None else kept.union(some)
    return written(kept, "kept-expressions")


class Spelling:
    """The kept expressions of all models; what a word adds to the log-likelihood ratio of each."""

    def __init__(self, rows: Sequence[tuple]):
        """Rows are (gram, ratio in each model or None)."""
        self.tables = []
        for model in range(MODELS):
            of = sorted((r[0], r[1 + model]) for r in rows if r[1 + model] is not None)
            self.tables.append((np.array([g for g, _ in of], np.int64), np.array([x for _, x in of], float)))

    def words(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """(models, words): each letter adds the ratio of the longest kept expression that ends there, or nothing."""
        word, place, key = spelled(data, start, size)
        out = np.zeros((MODELS, len(size)))
        for model, (grams, ratios) in enumerate(self.tables):
            if not len(grams):
                continue
            open_ = np.arange(len(key))
            for n in range(ORDER, 1, -1):
                some = open_[place[open_] + 1 >= n]
                asked = key[some] & ((1 << 8 * n) - 1)
                at = np.minimum(np.searchsorted(grams, asked), len(grams) - 1)
                hit = grams[at] == asked
                out[model] += np.bincount(word[some[hit]], weights=ratios[at[hit]], minlength=len(size))
                found = np.zeros(len(key), bool)
                found[some[hit]] = True
                open_ = open_[~found[open_]]
        return out

    def texts(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words per text, (models, texts) sums of log-likelihood ratios)."""
        words = Words(data, borders, ALNUM)
        _, first, of = np.unique(words.hash, return_index=True, return_inverse=True)
        each = self.words(data, words.start[first], words.end[first] - words.start[first])
        owner = words.owner()
        sums = [np.bincount(owner, weights=e[of], minlength=len(borders) - 1) for e in each]
        return words.count.astype(np.int64), np.array(sums, float).reshape(MODELS, len(borders) - 1)


SUMS = [T.StructField("n", T.LongType(), False)] + [T.StructField(f"s{m}", T.DoubleType(), False) for m in range(MODELS)]


def _sums_of(docs: DataFrame, rows: Sequence[tuple], keep: Sequence[str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(Spelling(rows))

    def compute(data, borders):
        n, sums = sent.value.texts(data, borders)
        return {"n": pa.array(n)} | {f"s{m}": pa.array(sums[m]) for m in range(MODELS)}

    return with_text_columns(docs, "__t", compute, SUMS, keep)


def likelihoods(docs: DataFrame, kept: DataFrame, keep: Sequence[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns, n (words) and s0 to s2 (sums of log-likelihood ratios by model) of ``docs`` (with ``__t``).

    The kept expressions are counted first; a block of at most about ``block_bytes`` is broadcast. Blocks hold all
    expressions with the same last two bytes, and a letter's ratio depends on no others, so with several blocks each is
    looked up in a pass of its own and the sums of a text are added up by its SHA-256.
    """
    total = kept.count()
    blocks = max(1, -(-total * ENTRY_BYTES // block_bytes))
    part = F.pmod(F.xxhash64(F.col("gram").bitwiseAND(0xFFFF)), F.lit(blocks))
    fetched = lambda k: [tuple(r) for r in kept.where(part == k).collect()]
    if blocks == 1:
        return _sums_of(docs, fetched(0), keep)
    digest = F.sha2(F.col("__t").cast("binary"), 256).alias("__sha")
    sums = None
    names = [f"s{m}" for m in range(MODELS)]
    for k in range(blocks):
        some = _sums_of(docs.where("__t is not null").select(digest, "__t"), fetched(k), ["__sha"])
        some = some.where(" or ".join(f"{s} <> 0" for s in names)).select("__sha", *names).dropDuplicates(["__sha"])
        some = written(some.withColumn("k", F.lit(k)), f"ratios-{k}")
        sums = some if sums is None else sums.union(some)
    in_order = lambda s: F.aggregate(F.array_sort(F.collect_list(F.struct("k", s))), F.lit(0.0), lambda a, x: a + x[s])
    sums = written(sums.groupBy("__sha").agg(*[in_order(s).alias(s) for s in names]), "ratios")
    each = _sums_of(docs.select("*", digest), [], [*keep, "__sha"]).drop(*names)
    return each.join(sums, "__sha", "left").select(*keep, "n", *[F.coalesce(s, F.lit(0.0)).alias(s) for s in names])


def _place(sums: Column, words: Column) -> Column:
    """The length-normalised ratio, squeezed into -1 to 1."""
    x = sums / (words + PRIOR_WORDS)
    return x / (F.abs(x) + 0.05)


def _training(docs: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """(doc_id, h, label): one document of every text and label outside the held fold, by its hash of 64 bits."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label).cast("long").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & (fold(F.col("__id"), FOLDS) != HELD))
    each = docs.where("__t is not null").select("doc_id", F.xxhash64("__t").alias("h"))
    each = each.join(known, F.col("doc_id") == F.col("__id"))
    return written(each.groupBy("h", "label").agg(F.min("doc_id").alias("doc_id")), "training")


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Two Kneser-Ney models, one of toxic and one of ordinary texts, spell the words of a text letter by letter; a word
    counts once a text in learning, and equal texts of one label are one text. Expressions that are too rare to tell
    the classes apart fall back to shorter ones and then to counts of both classes together. The score is the sum of
    log-likelihood ratios over all words of the text, divided by their number and PRIOR_WORDS more, then made a
    probability by isotonic regression. That is fitted on ratios from models that have not seen the text: each half of
    the texts is looked at with what the other half taught; scores come from the model of both halves.

    All labelled rows outside the held fold teach, and counts grow with the corpus. Labels are counted first: up to
    SENT_LABELS (about 64 MB) they are broadcast, more of them are joined by a shuffle of the labelled texts. Only
    expressions that tell the classes apart come to the tasks that score, block by block. Labels other than 0 and 1 and rows without an id teach nothing;
    a null id is never held out; repeated rows teach as often as they stand there. Null and empty texts have the score
    of a text without evidence. Without labels every score is 0.
    """
    each = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("__t"))
    training = _training(each, labels, id_col, label)
    kind = (F.col("label") * 2 + F.pmod("h", F.lit(2))).cast("int").alias("kind")
    sent = F.broadcast(training) if training.count() <= SENT_LABELS else training
    texts = each.withColumn("h", F.xxhash64("__t")).join(sent, ["doc_id", "h"])
    words = written(word_counts(texts.select(F.col("__t").alias("text"), kind)), "words")
    kept = kept_expressions(written(expressions(words), "expressions"))
    scored = likelihoods(each.withColumn("h", F.xxhash64("__t")), kept, ["doc_id", "h"], block_bytes)
    scored = written(scored, "likelihoods")

    unseen = F.when(F.pmod("h", F.lit(2)) == 0, F.col("s0")).otherwise(F.col("s1"))
    cell = F.floor((_place(unseen, F.col("n")) + 1) / 2 * BINS)
    cells = scored.join(training, ["doc_id", "h"]).groupBy(cell.alias("cell")).agg(F.count("*"), F.avg("label"))
    counted = sorted(tuple(r) for r in cells.collect())
    knots, values = isotonic((np.array([r[0] for r in counted]) + 0.5) / BINS * 2 - 1,
                             [float(r[1]) for r in counted], [r[2] for r in counted])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                place = batch.column("place").to_numpy()
                made = np.interp(place, knots, values) if len(knots) else np.zeros(len(place))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made)], names=["doc_id", "score"])

    schema = T.StructType([scored.schema["doc_id"], T.StructField("score", T.DoubleType())])
    out = scored.select("doc_id", _place(F.col("s2"), F.col("n")).alias("place")).mapInArrow(run, schema)
    return out.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
