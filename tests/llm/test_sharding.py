import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import sharding


def check(rows, texts, shards, most_over):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    total = sum(r.size for r in rows)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    heaviest = max(r.size for r in rows)
    for s in range(shards):
        assert abs(sum(r.size for r in by[s]) - total / shards) <= most_over * total / shards + heaviest


def test_shards_are_even_and_keep_equal_texts_together(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.shard(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    check(rows, texts, 24, 0.04)
    homes = defaultdict(set)
    for r in rows:
        homes[r.text_crc32].add(r.shard)
    weight = Counter()
    for r in rows:
        weight[r.text_crc32] += r.size
    limit = 0.04 * sum(weight.values()) / 24
    assert all(len(s) == 1 for c, s in homes.items() if weight[c] <= limit)


def test_a_hot_text_spreads(spark):
    rows = [(i, "the same text") for i in range(4000)] + [(4000 + i, f"text number {i}") for i in range(4000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    check(got, None, 8, 0.05)


def test_equal_rows_cannot_be_cut(spark):
    df = spark.createDataFrame([(1, "x" * 100)] * 50, "doc_id long, text string")
    rows = sharding.shard(df, shards=4).collect()
    assert sorted(r.slot for r in rows) == list(range(50)) and len({r.shard for r in rows}) == 1


def test_odd_rows_and_fewer_rows_than_shards(odd_documents, no_documents):
    rows = sharding.shard(odd_documents, keep=["lang", "size"]).collect()
    assert len(rows) == odd_documents.count() and {r.size for r in rows if r.doc_id in (3, 4)} == {8}
    assert sharding.shard(no_documents).count() == 0


@pytest.mark.parametrize("tolerance", [0.5, 0.01])
def test_splitters_count_exactly(spark, tolerance):
    rows = [((i * 7919) % (1 << 40) << 20, i % 50 + 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "key long, size long")
    cuts, below = sharding.splitters(df, 5, tolerance)
    assert cuts == sorted(cuts)
    assert below == [sum(s for k, s in rows if k < c) for c in cuts]
