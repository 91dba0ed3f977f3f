"""Spelling models against plain Kneser-Ney in Python, and held-out accuracy on the given tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity as tx

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return [w.lower() for w in WORD.findall((text or "").encode())]


def letters(word):
    b = b" " + word + b" "
    return [b[max(0, i + 1 - tx.ORDER) : i + 1] for i in range(1, len(b))]


def plain_model(texts):
    """{expression: log ratio} from (text, toxic): interpolated Kneser-Ney by class, then what differs beyond chance."""
    levels = {n: defaultdict(lambda: [0, 0]) for n in range(1, tx.ORDER + 1)}
    for text, toxic in texts:
        for word in set(words_of(text)):
            for gram in letters(word):
                levels[len(gram)][gram][toxic] += 1
    for n in range(tx.ORDER, 1, -1):
        for gram, count in levels[n].items():
            for c in (0, 1):
                levels[n - 1][gram[1:]][c] += count[c] > 0
    below, kept = {}, {}
    for n in range(1, tx.ORDER + 1):
        totals, kinds = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for gram, count in levels[n].items():
            for c in (0, 1):
                totals[gram[:-1]][c] += count[c]
                kinds[gram[:-1]][c] += count[c] > 0
        now = {}
        for gram, count in levels[n].items():
            total, kind = totals[gram[:-1]], kinds[gram[:-1]]
            back = below[gram[1:]] if n > 1 else [sum(count) / sum(total)] * 2
            now[gram] = [(max(count[c] - tx.DISCOUNT, 0) + tx.DISCOUNT * kind[c] * back[c]) / total[c] if total[c] else back[c]
                         for c in (0, 1)]
            if n > 1 and all(total) and max(beyond(count, total, 1), beyond(count, total, 0)) > tx.CHANCE:
                kept[gram] = math.log(now[gram][1] / now[gram][0])
        below = now
    return kept


def beyond(count, total, a):
    b = 1 - a
    share = total[a] * tx.FACTOR / (total[a] * tx.FACTOR + total[b])
    want = sum(count) * share, sum(count) * (1 - share)
    if count[a] <= want[0]:
        return 0.0
    return 2 * sum(k * math.log(k / w) for k, w in zip((count[a], count[b]), want) if k)


def plain_sum(kept, text):
    total = 0.0
    for word in words_of(text):
        for gram in letters(word):
            total += next((kept[gram[-n:]] for n in range(len(gram), 1, -1) if gram[-n:] in kept), 0.0)
    return total


def corpus(n, seed=1):
    rng = random.Random(seed)
    part = ["an", "ber", "cho", "du", "en", "fi", "gös", "ho"]
    bad = ["idiot", "scum"]

    def word(toxic):
        if toxic and rng.random() < 0.15:
            return rng.choice([rng.choice(bad), "zlowe" + rng.choice(part)])
        return "".join(rng.choices(part, k=rng.randint(1, 3)))

    made = []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        text = " ".join(word(toxic) for _ in range(rng.randint(1, 60)))
        made.append((i, text.capitalize().replace(" du ", ", DU! "), toxic))
    return made


def test_models_and_sums_match_plain_python(spark):
    made = corpus(300)
    texts = spark.createDataFrame([(i, t, y) for i, t, y in made], "doc_id long, text string, toxic int")
    texts = texts.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))
    half = {r.doc_id: r.half for r in texts.collect()}
    words = tx.word_counts(texts.select("text", (F.col("toxic") * 2 + F.col("half")).cast("int").alias("kind")))
    kept = tx.kept_expressions(tx.expressions(words))
    want = [plain_model([(t, y) for i, t, y in made if half[i] in of]) for of in ((1,), (0,), (0, 1))]
    rows = {r.gram.to_bytes(8, "big").lstrip(b"\0"): r for r in kept.collect()}
    for m, model in enumerate(want):
        got = {g: r[f"llr{m}"] for g, r in rows.items() if r[f"llr{m}"] is not None}
        assert got == pytest.approx(model) and model
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus(80, 2)] + [(900, None), (901, ""), (902, "x" * 100_000)], "doc_id long, __t string")
    one = {r.doc_id: r for r in tx.likelihoods(docs, kept, ["doc_id"]).collect()}
    several = {r.doc_id: r for r in tx.likelihoods(docs, kept, ["doc_id"], block_bytes=tx.ENTRY_BYTES * 7).collect()}
    for r in docs.collect():
        assert one[r.doc_id].n == several[r.doc_id].n == len(words_of(r["__t"]))
        for m, model in enumerate(want):
            expected = pytest.approx(plain_sum(model, r["__t"]), abs=1e-9)
            assert one[r.doc_id][f"s{m}"] == expected and several[r.doc_id][f"s{m}"] == expected


def test_planted_toxic_words_and_spellings(spark):
    made = corpus(1500, 5)
    docs = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id long, toxic int")
    got = {r.doc_id: r for r in tx.toxicity_scores(docs, labels).collect()}
    assert len(got) == len(made)
    seen = [(y, got[i].predicted) for i, t, y in made
            if zlib.crc32(str(i).encode()) % 4 == 2 and (not y or re.search("idiot|scum|zlowe", t.lower()))]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in made)
    hit = Counter(seen)
    assert hit[1, 1] > 0.97 * (hit[1, 1] + hit[1, 0]) and hit[0, 0] > 0.95 * (hit[0, 0] + hit[0, 1])


def test_labels_do_not_leak(spark, table):
    """Labels of the held fold change no score."""
    docs, labels = table("documents"), table("labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = ({r.doc_id: r.score for r in tx.toxicity_scores(docs, x).collect()} for x in (labels, turned))
    assert first == second


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(1, 1, "x"), (1, 1, "x"), (2, 0, "x"), (6, None, "x"), (None, 1, "x"), (8, 7, "x"), (9, 0, "x")],
        "doc_id long, toxic int, score string")
    got = tx.toxicity_scores(odd_documents, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert tx.toxicity_scores(no_documents, labels).count() == 0
    none = tx.toxicity_scores(odd_documents, labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
