import hashlib
import random

import numpy as np
import pytest

from relforge.llm import substring_dedup as D
from relforge.llm.anchors import LENGTH, spans
from relforge.llm.sais import permuted_lcp, suffix_array


def brute(docs):
    seen, out = set(), {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(b[k : k + 100])
        left = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def repetitive(seed, n=70):
    """Shared passages of 90 to 400 bytes at random places, runs of one word, near copies, copies."""
    rng = random.Random(seed)
    fill = lambda k: "".join(rng.choice("abcdefgh éß ") for _ in range(k))
    shared = [fill(rng.choice((90, 100, 101, 150, 400))) for _ in range(8)] + ["be " * 60, "x" * 250]
    docs = []
    for i in range(n):
        t = "".join(rng.choice(shared) if rng.random() < 0.5 else fill(rng.randrange(0, 300)) for _ in range(rng.randrange(0, 6)))
        if docs and rng.random() < 0.25:
            t = rng.choice(docs)[1]
            if t and rng.random() < 0.6:
                k = rng.randrange(len(t))
                t = t[:k] + "#" + t[k + 1 :]
        docs.append((3 * i - 20, t))
    return docs


@pytest.mark.parametrize("hot", [None, 1])
def test_matches_brute_force(spark, some_docs, hot, monkeypatch):
    if hot is not None:  # every anchor with several texts takes the way for hot anchors
        monkeypatch.setattr(D, "HOT", hot)
    docs = repetitive(1) + [(1000 + i, t) for i, t in some_docs[:60]]
    assert result(D.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_odd_rows(spark, odd_docs, no_docs):
    df = D.remove_repeats(odd_docs)
    assert df.count() == 9 and D.remove_repeats(no_docs).count() == 0
    got = result(df)
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[2] == got[3] == (0, 0, 0, nothing)
    assert got[5][0] == 60_000 and got[5][1] == 59_998  # all but the two first windows' own bytes
    assert got[6][1] == 0 and got[None][1] == 0


@pytest.mark.parametrize("alphabet", ["ab", "abcd"])
def test_suffix_array_and_prefixes(alphabet):
    rng = random.Random(len(alphabet))
    for _ in range(300):
        parts = [[ord(rng.choice(alphabet)) + 2 for _ in range(rng.randrange(25))] for _ in range(rng.randrange(1, 7))]
        starts = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
        text = [x for p in parts for x in [*p, 1]] + [0]
        array = suffix_array(np.array(text, np.uint8), 248).tolist()
        assert array == sorted(range(len(text)), key=lambda i: text[i:])
        common = permuted_lcp(np.array(text, np.uint8), np.array(array), starts, 200)
        for a, b in zip(array, array[1:]):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert common[b] == n


def test_spans_cover_each_window_and_follow_content(monkeypatch):
    rng = random.Random(2)
    data = bytes(rng.choice(b"ab ") for _ in range(5000))
    anchor, start, count, offset = spans(data)
    assert start.tolist() == np.concatenate([[0], np.cumsum(count)[:-1]]).tolist() and count.sum() == len(data) - LENGTH + 1
    shifted = dict()
    for a, s, c, o in zip(*spans(b"prefix" + data)):
        shifted.update({int(s) + k - 6: (int(a), int(o) - k) for k in range(c)})
    for a, s, c, o in zip(anchor, start, count, offset):
        for k in range(c):
            assert shifted[int(s) + k] == (int(a), int(o) - k)
    import relforge.llm.anchors as A
    monkeypatch.setattr(A, "_PIECE", 1024)
    windows = {int(s) + k: (int(a), int(o) - k) for a, s, c, o in zip(*spans(data)) for k in range(c)}
    assert len(windows) == len(data) - LENGTH + 1
    assert all(windows[int(s) + k] == (int(a), int(o) - k) for a, s, c, o in zip(anchor, start, count, offset) for k in range(c))
