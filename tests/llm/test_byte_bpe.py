import hashlib
import random
import time

import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relforge.llm import byte_bpe as B


@pytest.fixture(scope="module")
def model():
    return B.ByteBpe()


@pytest.fixture(scope="module")
def library(model):
    return tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=model.rank, special_tokens={})


def test_ids_equal_the_library(model, library, some_docs):
    rng = random.Random(3)
    # ՘ and ꟎ are newer to one table of letters than to the other
    parts = ["a", "b", "th", "the", "ing", " ", "  ", "\n", "\t", "é", "漢", "𐍈", "1", ".", "--", "    ", "self", "'s", "'ll", "\r\n", "\x1c", "\x85", "　", "՘", "꟎", "²", "ⅷ", "​", "́", "\x00"]
    texts = [t for _, t in some_docs] + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(5000)]
    for t in texts:
        ids = model.encode(t)
        assert ids == library.encode_ordinary(t or ""), t
        assert model.decode(ids) == (t or "").encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(model, library, text):
    assert model.encode(text) == library.encode_ordinary(text)


def test_every_character_is_cut_as_the_library_cuts(model, library):
    every = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)]]
    for at in range(0, len(every), 40_000):
        for glue in ("a", "!", " "):
            text = glue.join(every[at : at + 40_000])
            assert model.encode(text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 200_000, "ab" * 100_000, " " * 200_000, "漢字" * 50_000, "-=" * 100_000, "x" + " " * 50_000 + "y"])
def test_very_long_pre_tokens(model, library, text):
    began = time.time()
    assert model.encode(text) == library.encode_ordinary(text)
    assert time.time() - began < 30  # a scan for the lowest rank at each merge would take hours


def plain(rank, raw):
    """Byte pairs merged one by one: the lowest rank of all, the leftmost of equal ones."""
    if raw in rank:
        return [rank[raw]]
    symbols = [bytes([b]) for b in raw]
    while True:
        found = [(rank[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in rank]
        if not found:
            return [rank[s] for s in symbols]
        _, i = min(found)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


@settings(max_examples=300, deadline=None)
@given(st.sets(st.binary(min_size=2, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=60), st.randoms(use_true_random=False),
       st.lists(st.text("abc", max_size=40), min_size=1, max_size=4), st.sampled_from([1, 7, 300]))
def test_any_ranks_against_plain_merging(tokens, rng, texts, step):
    """Ranks in any order: a merge may queue a pair of a lower rank than its own, and one bucket holds pairs of several kinds."""
    order = sorted(tokens)
    rng.shuffle(order)
    rank = {bytes([b]): b for b in range(256)} | {t: 256 + step * i for i, t in enumerate(order)}
    merge = B.merger(rank)
    for text in texts:
        assert merge(text.encode()) == plain(rank, text.encode())


def test_digests(spark, odd_docs, no_docs, library):
    back = {}
    for r in B.digests(B.decode(B.encode(odd_docs))).collect():
        back.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    for r in odd_docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r["text"] or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
        assert want in back[r["doc_id"]]
    assert B.digests(B.decode(B.encode(no_docs))).collect() == []
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted((r["doc_id"], r["raw"]) for r in B.decode(none).collect()) == [(1, None), (2, b"")]
    with pytest.raises(Exception, match="out of bounds"):
        B.decode(none.withColumn("ids", F.array(F.lit(99_999_999)))).collect()


def test_lists_decode_like_single_texts(model):
    rng = random.Random(4)
    lists = [None if rng.random() < 0.1 else [rng.randrange(50_256) for _ in range(rng.randrange(6))] for _ in range(300)]
    for at in (0, 17):
        found = model.decode_lists(pa.array(lists, pa.list_(pa.int32())).slice(at)).to_pylist()
        assert found == [model.decode(ids or []) for ids in lists[at:]]
