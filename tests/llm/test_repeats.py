import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import repeats


def brute(rows, length):
    seen = Counter()
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, b in texts:
        seen.update(b[s : s + length] for s in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((str(d), len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("mine") for c in ("key", "sha", "n_bytes", "anchor", "first", "spans")})
    return sorted((str(r[0]), *r[1:]) for r in repeats.remove_repeats(df, **options).collect())


def corpus(rng, alphabet, n=40):
    shared = ["".join(rng.choices(alphabet, k=rng.randrange(60, 200))) for _ in range(4)]
    rows = []
    for i in range(n):
        text = "".join(
            rng.choice(shared)[rng.randrange(20) :] if rng.random() < 0.4 else "".join(rng.choices(alphabet, k=rng.randrange(80)))
            for _ in range(rng.randrange(6)))
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij \n", "aé\0ÿ"])
def test_matches_brute_force(spark, alphabet):
    rows = corpus(random.Random(alphabet), alphabet)
    assert found(spark, rows, length=64, gram=16) == brute(rows, 64)


def test_odd_texts(spark):
    rng = random.Random(9)
    free = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    line = free(500)
    rows = [(1, None), (2, ""), (3, "a" * 2000), (4, "ab" * 5000), (5, line), (5, line), (None, line[:-1] + "!"), (None, None),
            (6, free(100) + line[:399] + free(50)), (7, free(70) + line[60:470]), (8, "é" * 700), (9, free(399)), (10, free(400)),
            (11, free(20_000)), (12, "xyz" * 3000 + free(300)), (13, free(30) + "xyz" * 200)]
    assert found(spark, rows) == brute(rows, 400)


def test_heavy_anchors_are_settled_start_by_start(spark, monkeypatch):
    monkeypatch.setattr(repeats, "ANCHOR_STARTS", 1)
    rows = corpus(random.Random(1), "abcd")
    assert found(spark, rows, length=64, gram=16) == brute(rows, 64)


def test_a_passage_in_every_text(spark):
    rng = random.Random(4)
    free = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    passage = free(450)
    rows = [(i, free(rng.randrange(600)) + passage + free(rng.randrange(600))) for i in range(300)]
    assert found(spark, rows) == brute(rows, 400)


@pytest.mark.parametrize("alphabet", [2, 4, 250])
def test_suffix_order(alphabet):
    rng = np.random.default_rng(alphabet)
    for _ in range(50):
        text = rng.integers(0, alphabet, rng.integers(1, 300)).astype(np.uint8)
        helper = repeats.helper_end(text, -1)
        raw = text.tobytes() + b"\0"
        order = repeats.suffix_order(raw, [(0, len(text), len(text))], 1000)
        assert [p for p in order if p < len(text)] == sorted(range(len(text)), key=lambda p: raw[p:-1])
        assert 0 <= helper <= len(text)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(df).count() == 0


def test_equal_windows_share_an_anchor_wherever_they_stand(spark, monkeypatch):
    rng = random.Random(3)
    free = lambda n: "".join(rng.choices("abcdefghijklmnop ", k=n))
    code = lambda g: int(repeats.gram_hashes(np.frombuffer(g.encode(), np.uint8), 16)[0])
    least = min((free(16) for _ in range(5000)), key=code)
    passage = free(10) + least + free(6) + least + free(16)  # the least gram of the window, twice
    assert len(passage) == 64
    leads = [(1 << 20) - 20, 700, 15]
    texts = [free(lead) + passage + free(50) for lead in leads]
    for lead, text in zip(leads, texts):
        _, first, last, at, _, _ = repeats.anchors_of(np.frombuffer(text.encode(), np.uint8), 64, 16)
        (i,) = np.flatnonzero((first <= lead) & (last >= lead))
        assert at[i] - lead == 10
    # the anchor is split by distance, and each part is sorted alone
    monkeypatch.setattr(repeats, "ANCHOR_STARTS", 60)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 1)
    rows = list(enumerate(texts[:2]))
    assert found(spark, rows, length=64, gram=16) == brute(rows, 64)


@pytest.mark.parametrize("gram", [8, 16])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij"])
def test_anchors_are_the_leftmost_least_grams(alphabet, gram):
    rng = random.Random(f"{alphabet} {gram}")
    for _ in range(40):
        period = "".join(rng.choices(alphabet, k=rng.choice([5, 40, 64 - gram + 1])))
        free = "".join(rng.choices(alphabet, k=rng.randrange(300)))
        text = np.frombuffer((free + period * rng.randrange(6) + free[:90]).encode(), np.uint8)
        codes, first, last, at, lo, hi = repeats.anchors_of(text, 64, gram)
        wanted = {}
        if len(text) >= 64:
            hashes = repeats.gram_hashes(text, gram).tolist()
            wanted = {s: min(range(s, s + 64 - gram + 1), key=lambda p: (hashes[p], p)) for s in range(len(text) - 63)}
        got = {s: int(p) for a, b, p in zip(first, last, at) for s in range(a, b + 1)}
        known = {s for a, b in zip(lo, hi) for s in range(a, b + 1)}
        assert all(wanted[s] == p for s, p in got.items())
        assert set(wanted) - set(got) <= known


def test_joins_by_anchor_and_by_text_have_plain_sides(spark, monkeypatch):
    plans = {}

    def written(df, name, write=repeats.written):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(repeats, "written", written)
    df = spark.createDataFrame([(i, "a" * 500) for i in range(3)], "doc_id long, text string")
    plan = repeats.remove_repeats(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan  # else Spark does not split a side with very many rows of a key
    assert plans["kinds"].count("Aggregate") == 1  # of the joined rows, by anchor and neighbourhood
