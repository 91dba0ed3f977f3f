"""Vector codes against plain Lloyd rounds over every entry."""

import hashlib

import numpy as np
import pytest

from tidemark.llm import codes


def plain(rows, parts=8, entries=16, rounds=6):
    """{vec_id: (code, error)}, digest of the entries; rows are (vec_id, integers)."""
    rows = sorted(rows)
    x = np.array([v for _, v in rows], np.int64).reshape(len(rows), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest(p):
        far = ((x[:, p, None, :] - books[p][None]) ** 2).sum(axis=2)
        return far.argmin(axis=1), far.min(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            who, _ = nearest(p)
            for e in range(books.shape[1]):
                if (who == e).any():
                    books[p][e] = x[who == e, p].sum(axis=0) // (who == e).sum()
    made = [nearest(p) for p in range(parts)]
    error = sum(far for _, far in made)
    code = ["".join(f"{made[p][0][i]:02x}" for p in range(parts)) for i in range(len(rows))]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return {rows[i][0]: (code[i], int(error[i])) for i in range(len(rows))}, digest


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("seed, spread", [(0, 4096), (1, 3)])
def test_ball_assignment_is_exact(seed, spread):
    """Small spreads give many equal distances: the lower index wins."""
    rng = np.random.default_rng(seed)
    x, entries = rng.integers(-spread, spread + 1, (3000, 4)), rng.integers(-spread, spread + 1, (16, 4))
    entries[7] = entries[3]
    far = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    for owner in (np.zeros(len(x), np.int64), rng.integers(0, 16, len(x)), far.argmin(axis=1)):
        nearest, best, asked = codes.ball_assign(x, owner, entries)
        assert (nearest == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
    assert asked < len(x) * 16


def test_cores_and_rings_skip_distances():
    rng = np.random.default_rng(2)
    entries = rng.integers(-40_000, 40_000, (16, 4))
    owner = rng.integers(0, 16, 20_000)
    x = entries[owner] + rng.integers(-300, 300, (20_000, 4))
    _, _, asked = codes.ball_assign(x, owner, entries)
    assert asked < 1.2 * len(x)


@pytest.mark.parametrize("refresh", [1, 3])
def test_rounds_match_plain_lloyd(spark, refresh):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=16).astype(np.float32)) for i in rng.permutation(200)]
    rows += [(300 + i, rows[i][1]) for i in range(20)]
    want, digest = plain([(i, np.floor(v.astype(float) * 4096).astype(int).tolist()) for i, v in rows])
    got = codes.code_report(frame(spark, [(i, v.tolist(), i % 3 or None) for i, v in rows]), refresh=refresh).collect()
    assert {r.vec_id: (r.code, r.error) for r in got} == want
    assert {r.codebooks_sha256 for r in got} == {digest}
    by_label = {}
    for i, (_, error) in want.items():
        by_label[i % 3 or None] = by_label.get(i % 3 or None, 0) + error
    assert all(r.label_error == by_label[r.vec_id % 3 or None] for r in got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.25, 1.0, 2.0], 1), (1, [0.5, -0.25, 1.0, 2.0], 1), (1, [0.1, 0.2, 0.3, 0.4], None),
        (2, None, 1), (3, [nan, 1.0, 1.0, 1.0], 1), (4, [1.0, None, 1.0, 1.0], 1), (5, [inf, 0.0, 0.0, 0.0], 1),
        (6, [1.0, 2.0], 1), (7, [], 1), (8, [1e30, 0.0, 0.0, 0.0], 1), (None, [0.1, 0.2, 0.3, 0.5], None), (9, [-0.0001, 0.0, 0.0, 0.0], 2),
    ]
    made, books = codes.compressed(frame(spark, rows), parts=2, entries=3)
    got = made.collect()
    assert sorted((r.vec_id for r in got), key=str) == [1, 1, 1, 9, None]
    assert [p.shape for p in books.parts] == [(3, 2), (3, 2)]
    assert {tuple(r.v) for r in got if r.vec_id == 9} == {(-1, 0, 0, 0)}
    # more parts than components: parts without components
    assert {len(r.code) for r in codes.compressed(frame(spark, rows), entries=3)[0].collect()} == {8}
    report = codes.code_report(frame(spark, rows).withColumn("code", codes.F.lit("mine")), parts=2, entries=3)
    assert report.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    none = {r.label_error for r in report.collect() if r.vec_id is None}
    assert len(none) == 1
    assert codes.code_report(frame(spark, rows).where("false")).count() == 0


def test_integers_take_their_floor_and_keep_large_sums(spark):
    rows = [(i, [30_000.0 if i % 2 else -30_000.0, 1.0], 0) for i in range(40)]
    made, books = codes.compressed(frame(spark, rows), parts=1, entries=2)
    assert books.parts[0].tolist() == [[-122_880_000, 4096], [122_880_000, 4096]]
    assert {r.error for r in made.collect()} == {0}
