import math

import numpy as np

from strandweave.llm import ann, queries
from tests.oracle import assert_same

SCHEMA = "vec_id long, embedding array<float>, label int, score double, block long, rank int"


def brute(rows, k=20, every=20):
    good = [(n, i, [float(x) for x in v]) for n, (i, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, i, q in good:
        if i is None or i % every:
            continue
        near = []
        for m, j, c in good:
            if m == n or len(c) != len(q):
                continue
            s = 0.0
            for a, b in zip(q, c, strict=True):
                s += a * b
            near.append((-s, math.inf if j is None else j, j))
        near.sort(key=lambda x: x[:2])
        out += [(i, r, j, -s) for r, (s, _, j) in enumerate(near[:k], 1)]
    return sorted(map(repr, out))


def run(spark, rows, **how):
    frame = spark.createDataFrame([(i, v, 0, 0.0, 0, 0) for i, v in rows], SCHEMA).repartition(3)
    return sorted(repr((r.query_id, r["rank"], r.vec_id, r.score)) for r in ann.search(frame, **how).collect())


def test_query(spark, small):
    assert_same(queries.op9_nearest_neighbours(spark, small), ann.ORACLE_SQL, small)


def test_odd_vectors(spark):
    f32 = lambda v: [float(np.float32(x)) for x in v]
    rng = np.random.default_rng(6)
    rows = [(i, f32(rng.standard_normal(8))) for i in range(60)]
    rows += [(100, None), (120, []), (140, [0.0] * 8), (160, [1.0, None] * 4), (180, [math.nan] * 8), (200, [math.inf] + [1.0] * 7)]
    rows += [(20, rows[20][1]), (20, rows[20][1]), (None, rows[3][1]), (220, [1.0, 2.0]), (221, [2.0, 1.0]), (240, [5.0])]
    rows += [(300 + i, rows[0][1]) for i in range(40)]  # more ties than places
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, k=3) == brute(rows, k=3)
    assert run(spark, []) == []


def test_double_vectors_are_not_rounded(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(repr((r.query_id, r["rank"], r.vec_id, r.score)) for r in ann.search(frame).collect()) == brute(rows)


def test_tiles_keep_every_near_pair(monkeypatch):
    rng = np.random.default_rng(8)
    c = rng.standard_normal((700, 24)) * rng.choice([1e-3, 1.0, 1e3], (700, 1))
    q = np.vstack([c[:30], c[40:50]])
    uid = np.r_[0:30, 40:50]
    monkeypatch.setattr(ann, "EXACT_DIMS", 7)  # several stretches
    monkeypatch.setattr(ann, "STRIP", 16)
    best = ann.Best(uid, uid, q, 20)
    for at in (0, 5, 300, 310):  # blocks smaller and larger than k
        part = slice(at, {0: 5, 5: 300, 300: 310, 310: 700}[at])
        best.meet(np.arange(700)[part], np.arange(700)[part], c[part])
    for k, own in enumerate(uid):
        s = np.array([ann.exact_products(q[k : k + 1], c[j : j + 1])[0] for j in range(700)])
        s[own] = -np.inf
        want = np.lexsort((np.arange(700), -s))[:20]
        assert best.other[best.row == k].tolist() == want.tolist() and best.score[best.row == k].tolist() == s[want].tolist()


def test_vectors_that_overflow(spark):
    rng = np.random.default_rng(14)
    rows = [(i, (rng.standard_normal(6) * (1e160 if 30 <= i < 60 else 1)).tolist()) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(frame, k=5, every=10).collect()
    for q in range(0, 60, 10):
        own = {r.vec_id: r.score for r in got if r.query_id == q}
        assert len(own) == 5
        with np.errstate(all="ignore"):
            s = {j: float(ann.exact_products(np.array([rows[q][1]]), np.array([v]))[0]) for j, v in rows if j != q}
        rank = sorted(s, key=lambda j: (-(-math.inf if math.isnan(s[j]) else s[j]), j))[:5]
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == rank
        assert all(repr(own[j]) == repr(s[j]) for j in rank)


def test_grid_of_several_shares_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(15)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(6)]) for i in range(500)]
    # Constants are read on the driver, but for the size of a block.
    monkeypatch.setattr(ann, "SHARE", 60)
    monkeypatch.setattr(ann, "CELL_ROWS", 100)
    assert run(spark, rows, k=7, every=5) == brute(rows, k=7, every=5)


def test_error_bound_holds():
    rng = np.random.default_rng(3)
    a, b = rng.standard_normal((50, 64)), rng.standard_normal((80, 64)) * 10
    (ka, sa, na, ra), (kb, sb, nb, rb) = ann.quantise(a), ann.quantise(b)
    near = ann.int8_products(ka, kb) * (sa[:, None] * sb)
    bound = na[:, None] * rb + ra[:, None] * (nb + rb) + ann.ROUNDING * (na + ra)[:, None] * (nb + rb)
    assert (np.abs(near - a @ b.T) <= bound).all() and (ka == np.rint(ka)).all() and np.abs(ka).max() <= 127
