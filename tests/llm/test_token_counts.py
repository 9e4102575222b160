import random
import time

import pytest

from relforge.llm import token_counts as T


@pytest.fixture(scope="module")
def counter():
    return T.Counter()


def full(counter, text):
    return len(counter.encoding.encode_ordinary(text))


def test_counts_after_edits_equal_a_new_encoding(counter):
    rng = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "'", "s", "ll", "the", " x", "1", "é", "!!", "###", "漢", "\t", "   "]
    for it in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 2500 if it % 4 == 0 else 400)))
        tree = T.CountedText(text, counter)
        assert tree.tokens == full(counter, text)
        for _ in range(3):
            at = sorted(rng.sample(range(len(tree.text) + 1), min(len(tree.text) + 1, 2 * rng.randrange(4)) // 2 * 2))
            edits = [(a, b - a, "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 300])))) for a, b in zip(at[::2], at[1::2])]
            want = tree._edited(tree.text, edits, 0)
            tree.apply(edits)
            assert tree.text == want and tree.tokens == full(counter, want) and tree.tree.chars[1] == len(want)
            assert all(tree.tree.tokens[i] == tree.tree.tokens[2 * i] + tree.tree.tokens[2 * i + 1] for i in range(1, tree.tree.size))


def test_one_edit_counts_few_pretokens_again(counter):
    text = " ".join(f"word{i}" for i in range(50_000))
    tree = T.CountedText(text, counter)
    tree.apply([(len(text) // 2, 3, "new words")])
    assert tree.tokens == full(counter, tree.text) and tree.recounted <= 8 * T.LEAF < tree.pretokens / 100


def test_many_edits_of_a_long_text(counter):
    """4,000 edits of 4 MB cost less than counting anew, and each its own leaves only."""
    rng = random.Random(8)
    text = " ".join(f"word{rng.randrange(3000)}" for _ in range(420_000))
    began = time.perf_counter()
    tree = T.CountedText(text, counter)
    anew = time.perf_counter() - began
    at = sorted(rng.sample(range(0, len(text) - 10, 40), 4000))
    edits = [(a, rng.randrange(9), rng.choice(["", "x", " new words", "\n\n", "  "])) for a in at]
    began = time.perf_counter()
    tree.apply(edits)
    took = time.perf_counter() - began
    want = T.CountedText._edited(text, edits, 0)
    assert tree.text == want and tree.tokens == full(counter, want)
    assert tree.recounted <= 4000 * 4 * T.LEAF and took < anew
    # a few edits of it cost next to nothing
    began = time.perf_counter()
    for _ in range(20):
        tree.apply([(rng.randrange(len(want) - 100), 3, "ab")])
    assert time.perf_counter() - began < anew / 5 and tree.tokens == full(counter, tree.text)


def test_cleaning(spark, some_docs, counter):
    docs = spark.createDataFrame(some_docs, "doc_id long, text string")
    rows = {r.doc_id: r for r in T.edited_counts(docs).collect()}
    for i, text in some_docs:
        edits = T.cleaning_edits(text)
        assert rows[i].n_tokens == full(counter, text) and rows[i].n_edits == len(edits)
        assert rows[i].n_tokens_after == full(counter, T.CountedText._edited(text, edits, 0))


def test_table_of_edits(spark, counter):
    docs = spark.createDataFrame([(1, "some words are here"), (2, "others")], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 5, 5, "things"), (1, 0, 4, "all"), (9, 0, 0, "x")], "doc_id long, position long, length long, replacement string")
    rows = {r.doc_id: r for r in T.edited_counts(T.with_edits(docs, edits), edits_col="edits").collect()}
    assert rows[1].n_tokens_after == full(counter, "all things are here") and rows[1].n_edits == 2
    assert rows[2].n_edits == 0 and rows[2].n_tokens_after == rows[2].n_tokens


def test_odd_rows(spark, odd_docs, no_docs):
    rows = T.edited_counts(odd_docs).collect()
    assert len(rows) == 9 and {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert T.edited_counts(no_docs).count() == 0
