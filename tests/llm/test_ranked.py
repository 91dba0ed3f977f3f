"""Ranked search against brute force over every document and item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ranked
from tidemark.llm.batches import ALNUM, Words, flat

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return [w.lower() for w in WORD.findall((text or "").encode())]


def brute(docs, items, top=10):
    """Sorted (item_id, rank, doc_id, score); docs and items are lists of (id, text)."""
    bags = [(d, Counter(words_of(t))) for d, t in docs]
    bags = [(d, b, b.total()) for d, b in bags if b]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(w for _, b, _ in bags for w in b)
    out = []
    for i, text in items:
        found = []
        for d, b, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                * ((1_000_000_000 * b[w]) // (1000 * b[w] + 8 * m)) for w in words_of(text) if b[w])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranked.ranked(docs, items, **options).collect()), key=str)


def corpus(seed, n=120, copies=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "ünï", "ÉA", "x9", "你好"]
    text = lambda: " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))
    docs = [(rng.randrange(10_000), text()) for _ in range(n)]
    hot = text()
    docs += [(20_000 - i, rng.choice([hot, hot.upper(), hot.replace(" ", ", ")])) for i in range(copies)]
    docs += [(None, hot), (None, None), (7, ""), (7, hot), (8, " .,; ")]
    items = [(i, text()) for i in range(12)] + [(12, hot), (12, hot), (None, hot), (13, ""), (14, None), (15, "nowhere")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force_with_copies_ties_and_odd_rows(spark, seed):
    docs, items = corpus(seed)
    assert run(spark, docs, items) == brute(docs, items)


def test_blocks_of_items_and_shared_hashes(spark, monkeypatch):
    docs, items = corpus(3, 60, 15)
    want = brute(docs, items, 4)
    assert run(spark, docs, items, top=4, block_bytes=400) == want
    monkeypatch.setattr(ranked, "class_hash", lambda bag, m: F.pmod(F.xxhash64(bag, m), F.lit(3)))
    assert run(spark, docs, items, top=4) == want


def test_small_steps_give_the_same_scores(spark, monkeypatch):
    docs, items = corpus(4, 80, 10)
    for name, value in (("CELLS_AT_ONCE", 40), ("POOL", 8), ("COMPARED_AT_ONCE", 16)):
        monkeypatch.setattr(ranked, name, value)
    assert run(spark, docs, items) == brute(docs, items)


def test_words_are_confirmed_by_bytes():
    vocabulary = ranked.Vocabulary(["alpha beta", "beta gamma"])
    vocabulary.hash = np.full(vocabulary.size, 5, np.uint64)  # every word in one hash
    data, borders = flat(pa.array(["Gamma delta BETA alph alphas"]))
    words = Words(data, borders, ALNUM)
    words.hash = np.full(len(words.start), 5, np.uint64)
    names = [vocabulary.data[a:b].tobytes() for a, b in zip(vocabulary.borders, vocabulary.borders[1:])]
    assert [names[i] if i >= 0 else None for i in vocabulary.find(data, words)] == [b"gamma", None, b"beta", None, None]


def test_odd_rows_and_empty_tables(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "the quick fox w5 ändern", 9), (None, "one", 9)], "item_id long, text string, rank int")
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    want = brute(rows, [(1, "the quick fox w5 ändern"), (None, "one")])
    got = ranked.ranked(odd_documents, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert ranked.ranked(no_documents, items).count() == 0
    assert ranked.ranked(odd_documents, items.where("false")).count() == 0
