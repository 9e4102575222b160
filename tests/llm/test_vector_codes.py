import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from relforge.llm import vector_codes as V
from relforge.llm.anchors_tree import Forest

WIDE = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label) of plain k-means by part, and the codebooks."""
    kept = [(i, np.floor(4096 * np.array(v, np.float32).astype(float)).astype(int), lab) for i, v, lab in rows
            if v is not None and None not in v and np.isfinite(np.array(v, np.float32)).all()]
    x = np.array([v for _, v, _ in kept])
    starts = {}
    for i, v, _ in kept:
        starts[i] = min(starts.get(i, v.tolist()), v.tolist())
    first = sorted(starts, key=lambda i: (i is None, i))[:entries]
    width = x.shape[1] // parts
    entry, books = [], []
    for p in range(parts):
        cut = x[:, p * width : (p + 1) * width]
        book = np.array([starts[i][p * width : (p + 1) * width] for i in first])
        for k in range(rounds + 1):
            apart = ((cut[:, None] - book[None]) ** 2).sum(-1)
            near = apart.argmin(1)
            for e in range(len(book)):
                if k < rounds and (near == e).any():
                    book[e] = cut[near == e].sum(0) // (near == e).sum()
        entry.append((near, apart.min(1)))
        books.append(book)
    codes = ["".join(f"{near[v]:02x}" for near, _ in entry) for v in range(len(kept))]
    return [(kept[v][0], codes[v], int(sum(a[v] for _, a in entry)), kept[v][2]) for v in range(len(kept))], np.array(books)


def check(spark, rows, schema=WIDE, **more):
    want, books = brute(rows)
    totals = {}
    for _, _, error, label in want:
        totals[label] = totals.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(n) for b in books for e in b for n in e).encode()).hexdigest()
    got = V.code_table(spark.createDataFrame(rows, schema).repartition(3), **more)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((i, c, e, totals[lab], digest) for i, c, e, lab in want), key=key)


def clouds(n, width=32, spread=0.1, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    return [(int(i), [float(c) for c in (centres[i % 12] + rng.normal(size=width) * spread).astype(np.float32)], int(i % 5)) for i in range(n)]


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_equals_plain_k_means(spark, spread):
    check(spark, clouds(700, spread=spread), shard=4096)


def test_odd_rows(spark):
    rows = clouds(60, width=8)
    nan, inf = float("nan"), float("inf")
    rows += [(7, rows[7][1], 2), (7, rows[30][1], None), (None, rows[3][1], None), (None, rows[4][1], 1), (500, None, 1), (501, [nan] * 8, 1),
             (502, [0.0] * 7 + [inf], 1), (503, [None] + [0.0] * 7, 1), (504, [-0.0] * 8, 1), (505, [0.0] * 8, None)] + [(600 + i, rows[9][1], 3) for i in range(300)]
    check(spark, rows, shard=512)


def test_few_ids_and_equal_vectors(spark):
    check(spark, [(3, [0.5] * 16, 1), (1, [0.5] * 16, 1), (2, [-0.5] * 16, 2)])
    check(spark, [(i, [0.25] * 8, None) for i in range(200)])


def test_empty_and_wrong_lengths(spark):
    assert V.code_table(spark.createDataFrame([], WIDE)).collect() == []
    assert V.code_table(spark.createDataFrame([(1, None, 1)], WIDE)).collect() == []
    with pytest.raises(Exception, match="different lengths"):
        V.code_table(spark.createDataFrame([(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], WIDE).coalesce(1))
    with pytest.raises(Exception, match="cannot be cut"):
        V.code_table(spark.createDataFrame([(1, [0.0] * 9, 1)], WIDE))
    with pytest.raises(Exception, match="too large"):
        V.code_table(spark.createDataFrame([(1, [1e9] * 8, 1)], WIDE))


def test_extra_columns(spark):
    rows = clouds(40, width=8)
    plain = V.code_table(spark.createDataFrame(rows, WIDE)).collect()
    extra = spark.createDataFrame(rows, WIDE).withColumns({c: F.lit("z") for c in ("x", "code", "error", "_of", "width", "points", "part", "a.b")})
    assert sorted(V.code_table(extra).collect()) == sorted(plain)


def test_codes_decode_to_their_entries(spark):
    codes = V.compress(spark.createDataFrame(clouds(100), WIDE))
    for r in codes.rows.withColumn("back", codes.decode()).collect():
        want = np.concatenate([codes.books[p, int(r["code"][2 * p : 2 * p + 2], 16)] for p in range(8)])
        assert r["back"] == want.tolist()
    codes.drop()


def test_lists_shrink_until_a_ball_is_owned():
    """On parts that lie in clusters, most vectors are assigned as whole balls, without a look at them."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (16, 4))
    points = centres[rng.integers(0, 16, 4000)] + rng.integers(-5, 6, (4000, 4))
    parts = points.reshape(1, 4000, 4)
    forest = Forest.load(Forest.over(parts).dump())
    walk = forest.walk(parts, centres[None])
    assert (walk.entry[0] == ((points[:, None] - centres[None]) ** 2).sum(-1).argmin(1)).all()
    assert walk.owned > 3800 and walk.looked < 400
    # balls: slices within their parent's, sums and radii of exactly their points
    for b in range(len(forest.low)):
        held = points[forest.order[0, forest.low[b] : forest.high[b]]]
        assert (held.sum(0) == forest.total[b]).all()
        assert np.sqrt(((held - forest.centre[b]) ** 2).sum(1)).max() <= forest.radius[b]
        for kid in forest.kids[b]:
            assert kid < 0 or forest.low[b] <= forest.low[kid] < forest.high[kid] <= forest.high[b]
