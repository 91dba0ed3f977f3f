import zlib

import numpy as np
import pytest

from tidemark.llm import quality


@pytest.fixture(scope="module")
def scores(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_scores(docs, labels).collect()
    return rows, {r.doc_id: r.quality for r in labels.collect()}


def test_held_out_accuracy(scores):
    rows, labels = scores
    known = [(r.predicted, labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    good = [s for _, y, s in known if y == 1]
    bad = np.array([s for _, y, s in known if y == 0])
    rank = np.mean([(bad < s).mean() + 0.5 * (bad == s).mean() for s in good])
    assert len(known) > 500 and np.mean([p == y for p, y, _ in known]) > 0.97 and rank > 0.98
    assert sum(p == 0 and y == 1 for p, y, _ in known) <= 0.01 * len(good)


def test_folds_scores_and_threshold(scores):
    rows, _ = scores
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_held_out_labels_do_not_matter(spark, table):
    from pyspark.sql import functions as F

    docs, labels = table("documents"), table("labels")
    turned = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.quality_scores(docs, turned).collect()}
    assert a == pytest.approx(b, abs=1e-9)


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    n, d = 4000, len(quality.STATISTICS)
    model = quality.Model(np.zeros(d), np.ones(d), rng.normal(size=(d, n)) / 3, rng.uniform(0, 2 * np.pi, n), None, None, None)
    x = rng.normal(size=(6, d))
    z = model.features(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 9))
    assert np.abs(z @ z.T - want).max() < 0.1


def test_isotonic_pools_violators():
    knots, values = quality.isotonic(np.array([1.0, 2, 3, 4]), np.array([1.0, 1, 1, 1]), np.array([0.0, 1, 0, 1]))
    assert knots.tolist() == [1, 2.5, 4] and values.tolist() == [0, 0.5, 1]


def test_normal_equations_are_sums_over_all_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, len(quality.STATISTICS)))
    y = (x[:, 0] > 0).astype(float)
    train = spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(x, y)], "statistics array<double>, label double")
    model = quality.fit(train.repartition(7), waves=16)
    z = model.features(x)
    penalty = np.diag(np.append(np.ones(16), 1e-6))
    assert model.coefficients == pytest.approx(np.linalg.solve(z.T @ z + penalty, z.T @ y), abs=1e-6)


def test_odd_rows(spark, table, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (6, 1)], "doc_id long, quality int")
    rows = quality.quality_scores(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    unlabelled = quality.quality_scores(odd_documents, labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in unlabelled} == {(0.5, 1)}
    assert quality.quality_scores(no_documents, labels).count() == 0
    kept = quality.good_documents(odd_documents, labels.where("false"))
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count()


def test_each_row_is_judged_by_its_own_text(spark, table):
    docs, labels = table("documents"), table("labels")
    predicted = {r.doc_id: r.predicted for r in quality.quality_scores(docs, labels).collect()}
    bad, good = (next(d for d, p in sorted(predicted.items()) if p == want) for want in (0, 1))
    texts = {r.doc_id: r.text for r in docs.where(docs["doc_id"].isin(bad, good)).collect()}
    # ids that no label names: the fitted model stays the same
    extra = [(None, texts[bad]), (None, texts[good]), (-5, texts[bad]), (-5, texts[good])]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    kept = [(r.doc_id, r.text) for r in quality.good_documents(more, labels).collect()]
    assert sorted((d or 0, t) for d, t in kept if d is None or d == -5) == [(-5, texts[good]), (0, texts[good])]
