import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.batches import flat


def plain(text, shingle=3):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, most=2):
    """Smallest id reachable, by comparing all pairs."""
    ids = sorted(fps)
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= most:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_groups_match_all_pairs(table):
    texts = {r.doc_id: r.text for r in table("documents").collect()}
    fps = {d: plain(t) for d, t in texts.items()}
    want = groups(fps)
    got = simhash.near_duplicates(table("documents")).collect()
    assert {r.doc_id: (r.simhash % (1 << 64), r.component_id) for r in got} == {d: (fps[d], want[d]) for d in fps}


def links_of(spark, fps, most):
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in fps.items()], "fp long, node long")
    return simhash.components(simhash.links(df, most))


def test_links_find_every_place_of_the_difference(spark, monkeypatch):
    rng = random.Random(3)
    fps, at = {}, 0
    for _ in range(60):
        base = rng.getrandbits(64)
        for flips in (0, 1, 2, 2, 3):
            fps[at] = base
            for bit in rng.sample(range(64), flips):
                fps[at] ^= 1 << bit
            at += 1
    fps = {i: f for f, i in {f: i for i, f in sorted(fps.items(), reverse=True)}.items()}
    want = groups(fps)
    got = {r.node: r.component for r in links_of(spark, fps, 2).collect()}
    assert {i: got.get(i, i) for i in fps} == want


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {i: base ^ rng.getrandbits(12) for i in range(300)}
    fps = {i: f for f, i in {f: i for i, f in sorted(fps.items(), reverse=True)}.items()}
    got = {r.node: r.component for r in links_of(spark, fps, 2).collect()}
    assert {i: got.get(i, i) for i in fps} == groups(fps)


def test_chain_condition_never_loses_a_link():
    rng = np.random.default_rng(1)
    for most in (1, 2, 3):
        for _ in range(200):
            bits = rng.choice(64, rng.integers(0, most + 1), replace=False)
            d = np.array([np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64), initial=np.uint64(0))])
            starts = np.arange(simhash.SEGMENTS)
            assert simhash.chain_holds(np.repeat(d, len(starts)), starts, most).any()


def test_long_texts_are_hashed_whole():
    import pyarrow as pa

    text = " ".join(f"w{i}" for i in range(300_000))
    got = simhash.fingerprints_of(*flat(pa.array([text, None, "a", "A b"])), 3)
    assert got.tolist() == [plain(text), 0, plain("a"), plain("a b")]


def test_odd_rows(odd_documents, no_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.simhash, r.component_id))
    assert by[1] == by[2] and {c for _, c in by[1]} == {1}
    assert by[3] == by[4] == by[5] == {(0, 3)}  # no words: fingerprint zero, linked like any other
    assert (0, 3) in by[None]
    kept = simhash.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 6, 7, 8, 9]
    assert simhash.near_duplicates(no_documents).count() == 0 and simhash.one_of_each(no_documents).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(500)] + [(5000, 5000), (None, 3)]
    edges += [(7000 + rng.randrange(100), 7000 + rng.randrange(100)) for _ in range(80)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    assert got == {x: root(x) for x in up}
    empty = spark.createDataFrame([], "a long, b long")
    assert simhash.components(empty).where(F.lit(True)).count() == 0
