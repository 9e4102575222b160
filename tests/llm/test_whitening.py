import numpy as np
import pytest
from pyspark.sql import functions as F

from relforge.llm import whitening as W

WIDE = "vec_id long, embedding array<float>, label int"


def vectors(n, width, seed=5):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(width, width))
    return [(int(i), [float(c) for c in (rng.normal(size=width) @ mix + 3).astype(np.float32)], 1) for i in range(n)]


def brute(rows, top=4):
    """{vec_id: whitened} up to signs, explained, deviations, by numpy on the distinct integer vectors."""
    kept = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v, _ in rows
            if v is not None and None not in v and np.isfinite(np.array(v, np.float32)).all()]
    fit = np.unique([x for _, x in kept], axis=0)
    n, sums = len(fit), fit.sum(0)
    z = (fit * n - sums).astype(float) / n
    values, basis = np.linalg.eigh(z.T @ z / n)
    values, basis = values[::-1], basis[:, ::-1]
    x = np.array([v for _, v in kept])
    shown = ((x * n - sums) / n) @ basis[:, :top] / np.sqrt(values[:top])
    return [i for i, _ in kept], shown, values[:top] / values.sum(), [sum(int(c) ** 2 for c in row) for row in x * n - sums], n


def test_equals_numpy(spark):
    rows = vectors(500, 12)
    rows += [(7, rows[7][1], 2), (7, rows[8][1], None), (None, rows[3][1], None), (900, None, 1), (901, [float("nan")] * 12, 1),
             (902, [None] + [0.0] * 11, 1), (903, [float("inf")] * 12, 1)] + [(1000 + i, rows[9][1], 3) for i in range(300)]
    ids, shown, explained, deviation, n = brute(rows)
    got = W.whitened_table(spark.createDataFrame(rows, WIDE).repartition(3)).collect()
    assert len(got) == 4 * len(ids)
    assert {r["n"] for r in got} == {n} == {500} and got[0]["identity_error"] < 1e-9
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for k in range(4):
        mine = sorted((r["vec_id"], r["deviation"], r["whitened"]) for r in got if r["component"] == k + 1 and r["vec_id"] is not None)
        want = sorted((i, d, s) for i, d, s in zip(ids, deviation, shown[:, k]) if i is not None)
        assert [m[1] for m in sorted(mine, key=key)] == [w[1] for w in sorted(want, key=key)]
        sign = np.sign(sum(m[2] * w[2] for m, w in zip(sorted(mine, key=key), sorted(want, key=key))))
        by_id = {}
        for i, _, s in want:
            by_id.setdefault(i, []).append(s)
        for i, _, s in mine:
            assert min(abs(s * sign - o) for o in by_id[i]) < 1e-9
        assert abs(next(r["explained"] for r in got if r["component"] == k + 1) - explained[k]) < 1e-12


def test_covariances_are_exact_far_from_zero(spark):
    """A mean a million times the spread: centred before squaring, so that nothing cancels."""
    rng = np.random.default_rng(2)
    x = rng.integers(-3, 4, (300, 5)) + np.array([10**9, -10**9, 10**9 + 7, 5, 0])
    model = W.fit(spark.createDataFrame([(v,) for v in np.unique(x, axis=0).tolist()], "x array<long>").repartition(3))
    fit = np.unique(x, axis=0)
    mean = np.array([sum(map(int, c)) for c in fit.T]) / len(fit)
    small = fit - np.floor(mean)
    want = np.cov(small.T, bias=True)
    assert np.abs(model.covariance - want).max() < 1e-12


def test_squares_beyond_64_bits():
    u = np.array([[2**40, -(2**40)], [2**41, 1], [3, 5]], np.int64)
    want = [sum(int(r[0]) ** 2 for r in u), sum((int(r[0]) + int(r[1])) ** 2 for r in u), sum(int(r[1]) ** 2 for r in u)]
    assert W._squares(u) == want
    u = np.full((9, 1), 2**30, np.int64)  # the sum needs more bits than each square
    assert W._squares(u) == [9 * 2**60]


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(2**22 * i), float(i)], 1) for i in range(2000)]
    got = {r["vec_id"]: r["deviation"] for r in W.whitened_table(spark.createDataFrame(rows, WIDE)).filter("component = 1").collect()}
    assert got[1999] is None and len(got) == 2000  # known exactly as a decimal, but no long
    kept = W.integers(spark.createDataFrame(rows, WIDE), "embedding")
    model = W.fit(kept.select("x"))
    exact = {r["vec_id"]: int(r["deviation"]) for r in W.whiten(kept, model).collect()}
    x = {i: (2**30 * i, 256 * i) for i in range(2000)}
    sums = [sum(v[k] for v in x.values()) for k in range(2)]
    assert all(exact[i] == sum((2000 * v[k] - sums[k]) ** 2 for k in range(2)) for i, v in x.items())


def test_flat_short_empty_and_extra(spark):
    assert W.whitened_table(spark.createDataFrame([], WIDE)).collect() == []
    one = W.whitened_table(spark.createDataFrame([(1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1)], WIDE)).collect()
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in sorted(one)] == [
        (i, k, 1, 0, None, 0.0) for i in (1, 2) for k in (1, 2)]
    line = W.whitened_table(spark.createDataFrame([(i, [float(i), float(i)], 1) for i in range(9)], WIDE)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line) and line[0]["identity_error"] < 1e-9
    extra = spark.createDataFrame(vectors(30, 6), WIDE).withColumns({c: F.lit("z") for c in ("x", "n", "component", "whitened", "vector", "a.b")})
    assert W.whitened_table(extra).count() == 120
    with pytest.raises(Exception, match="different lengths"):
        W.whitened_table(spark.createDataFrame([(1, [0.5], 1), (2, [0.5, 0.25], 1)], WIDE))
