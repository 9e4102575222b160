import random
from collections import Counter, defaultdict

import numpy as np

from relforge.llm import near_dup as N
from relforge.llm.graph import components
from relforge.llm.common import Scratch
from relforge.llm.text_sets import WordNumbers, shingles

SF = "/root/testdata/sf0.001"


def brute(docs):
    """component of each doc_id by comparing the sets of all texts that share a shingle."""
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = Counter((a, b) for own in holders.values() for a in own for b in own if a < b)
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def varied(seed=1, n=60):
    """Near copies around the threshold, groups of copies, and unrelated texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    docs, i = [], 0
    for _ in range(n // 6):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 120))]
        for k in range(6):
            own = base[:]
            for _ in range(rng.randrange(0, max(1, len(own) // 25) + 1) if k else 0):
                own[rng.randrange(len(own))] = rng.choice(words)
            docs.append((i := i + 1, " ".join(own).upper() if k == 5 else " ".join(own)))
    return docs


def test_matches_brute_force(spark, some_docs):
    docs = [(i, t) for i, t in some_docs] + [(10_000 + i, t) for i, t in varied()]
    rows = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = N.near_duplicates(odd_docs).collect()
    assert len(rows) == 9
    by = {r.doc_id: r for r in rows}
    assert (by[2].n_shingles, by[2].component_id, by[2].kept) == (0, 2, True)
    assert (by[3].component_id, by[7].component_id, by[4].n_shingles) == (3, 7, 1)
    assert by[None].component_id is None and by[None].kept
    assert by[6].component_id == 6
    left = N.deduplicate(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == 8  # one of the equal rows goes
    assert N.near_duplicates(no_docs).count() == 0


def test_one_doc_id_with_several_texts(spark):
    """Texts of one doc_id are one document: they join the groups of each of them."""
    rng = random.Random(2)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(50)}" for _ in range(40)) for x in "abcd")
    rows = [(0, a), (1, a), (1, b), (5, b), (7, c), (7, d), (7, d), (8, c), (9, d + " more"), (20, "alone " * 9), (20, None), (None, a)]
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    want = {0: 0, 1: 0, 5: 0, 7: 7, 8: 7, 9: 7, 20: 20, None: None}
    assert {r.doc_id: r.component_id for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    left = N.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, left), key=str) == sorted([(0, a), (7, min(c, d)), (20, None), (None, a)], key=str)


def test_sketch_bounds():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.integers(0, 2**63, 300, dtype=np.uint64)
        b = np.concatenate([a[: rng.integers(1, 300)], rng.integers(0, 2**63, rng.integers(1, 80), dtype=np.uint64)])
        d = len(set(a.tolist()) ^ set(b.tolist()))
        far = (N.parities(a, 4096) ^ N.parities(b, 4096)).view(np.uint64)
        bits = sum(int(x).bit_count() for x in far)
        assert bits <= d and (d - bits) % 2 == 0  # never over the true difference


def test_minhash_estimates():
    words = WordNumbers()
    a = shingles(" ".join(f"w{i}" for i in range(1000)), words)
    b = shingles(" ".join(f"w{i}" for i in range(200, 1200)), words)
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((N.minhash(a) == N.minhash(b)).mean() - j) < 0.15


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (300, 200), (300, 400)]
    got = components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test"), "c").collect()
    want = {i: 1 for i in range(1, 41)} | {100: 100, 200: 100, 300: 100, 400: 100}
    assert {r.node: r.comp for r in got} == want and len(got) == len(want)
