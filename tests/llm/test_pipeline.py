"""The pipeline against plain Python on the smallest tables, stage by stage on its own input."""

from collections import Counter

import corpus_pipeline
from llm.test_decontam import brute
from llm.test_simhash import groups, plain

from tidemark.llm import mixing, quality


def test_stages(spark, small, table):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "sharding"]
    docs = table("documents")
    rows = {r.doc_id: r for r in docs.collect()}
    good = corpus_pipeline.good(spark, docs, small)
    predicted = {r.doc_id: r.predicted for r in quality.quality_scores(docs, table("labels")).collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == {d for d, p in predicted.items() if p}
    unique = corpus_pipeline.unique(spark, docs, small)
    roots = groups({d: plain(r.text) for d, r in rows.items()})
    assert unique.columns == docs.columns and {r.doc_id for r in unique.collect()} == set(roots.values())
    clean = corpus_pipeline.clean(spark, docs, small)
    hits = brute([(d, r.text) for d, r in rows.items()], [(r.item_id, r.text) for r in table("benchmark").collect()])
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {d for d, h in hits.items() if not h[1]}
    mixed = corpus_pipeline.mixed(spark, docs, small)
    times = {r.doc_id: r.times for r in mixing.mix(docs).collect()}
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == +Counter(times)


def test_run(spark, small, table):
    made = corpus_pipeline.run(spark, small)
    assert made.columns == [*table("documents").columns, "size", "text_crc32", "shard", "slot"]
    rows = made.collect()
    assert rows
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_stages_take_odd_rows(spark, small, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, small).columns == docs.columns, name
            stage(spark, docs, small).count()
        assert corpus_pipeline.sharded(spark, docs, small).count() == docs.count()
