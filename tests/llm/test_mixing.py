import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_are_met_and_capped(table):
    rows = mixing.mix(table("documents")).collect()
    texts = {r.doc_id: r.text for r in table("documents").collect()}
    by = defaultdict(list)
    for r in rows:
        assert r.size == size(texts[r.doc_id]) and 0 <= r.times <= 3 and r.taken == r.size * r.times
        by[r.source].append(r)
    assert sum(v[0].target for v in by.values()) == pytest.approx(sum(r.size for r in rows))
    for own in by.values():
        assert own[0].target <= 3 * own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * max(r.size for r in own)


def test_water_filling_reshares_the_excess(spark):
    rows = [(i, "w " * 10, "a") for i in range(2)] + [(i, "w " * 10, "b") for i in range(2, 102)]
    rows += [(i, "w " * 10, "c") for i in range(102, 302)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.source: r.target for r in mixing.mix(df).select("source", "target").distinct().collect()}
    # a wants 5/8 of 3020 words but holds 20: it stops at 60; b and c share 2960 by 2 to 1, within 3 times their size
    assert got == {"a": pytest.approx(60), "b": pytest.approx(2960 * 2 / 3), "c": pytest.approx(2960 / 3)}


def test_reruns_and_partitions_agree(spark, table):
    first = sorted(mixing.mix(table("documents")).collect())
    assert sorted(mixing.mix(table("documents").repartition(13)).collect()) == first


def test_odd_rows(odd_documents):
    rows = mixing.mix(odd_documents, keep=["lang", "size"]).collect()
    assert len(rows) == odd_documents.count()
    none = [r for r in rows if r.source is None]
    assert {r.doc_id for r in none} == {4, 7, None} and all(isinstance(r.size, int) for r in rows)
    mixed = mixing.mixed_documents(odd_documents)
    assert mixed.columns == odd_documents.columns
    times = Counter()
    for r in rows:
        times[r.doc_id] += r.times
    assert Counter(r.doc_id for r in mixed.collect()) == +times


def test_empty(no_documents):
    assert mixing.mix(no_documents).count() == 0 and mixing.mixed_documents(no_documents).count() == 0
