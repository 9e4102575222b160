import random

import pytest
import sentencepiece

from relforge.llm import sentencepieces as S


@pytest.fixture(scope="module")
def model():
    return S.PieceModel()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL)


def test_ids_equal_the_library(model, library, some_docs):
    rng = random.Random(3)
    parts = ["a", "b", "e", "th", "the", "ing", " ", "  ", "\n", "\t", "é", "漢", "𐍈", "1", ".", "--", "    ", "self", "__", "er", "(", ");", "//", "\x00", "<s>", "<0x0A>"]
    texts = [t for _, t in some_docs] + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    for t in texts:
        ids = model.encode(t)
        assert ids == library.encode(t), t
        assert model.decode(ids) == t


def test_unigram_scores_equal_the_library(tmp_path):
    """The same pieces read as a unigram model: the best sum of scores, as the library finds it."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(S.MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:  # as log probabilities
        if p.type == 1:
            p.score = -8.0 - (-p.score if p.score > -1e8 else 32_000) / 4_001
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    model, library = S.PieceModel(path, unigram=True), sentencepiece.SentencePieceProcessor(model_file=path)
    assert S.PieceModel(path).unigram  # told from the scores
    rng = random.Random(9)
    parts = ["the", "ing", "re", "a", "t", "on", " ", "er", "st", "1", ".", "é"]

    def total(ids):
        return sum(library.get_score(i) for i in ids)
    for _ in range(400):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 40)))
        ids = model.encode(t)
        assert model.decode(ids) == t and abs(total(ids) - total(library.encode(t))) < 1e-2, t


def test_blanks_are_split_from_what_follows(model, library, monkeypatch):
    """Ids of the library, and no merge longer than a run of blanks."""
    assert model.blanks_last
    longest, real = [0], S.PieceModel.merged

    def merged(self, text):
        if len(text) > 64 or text.startswith(S.BLANK * 2):
            assert not text.strip(S.BLANK)
            longest[0] = max(longest[0], len(text))
        return real(self, text)
    monkeypatch.setattr(S.PieceModel, "merged", merged)
    rng = random.Random(12)
    for _ in range(3000):
        t = "".join(" " * rng.choice([1, 2, 3, 5, 15, 16, 17, 33]) + rng.choice(["the", "x", "漢", "é", "\n", "1", "_", "(", "\t", "𐍈", "self", "", "\x00", "▁", "▁▁a"]) for _ in range(rng.randrange(1, 8)))
        assert model.encode(t) == library.encode(t), repr(t)
    for rest in ("漢" * 200_000, "ab" * 50_000, "the " * 1000):
        assert model.encode("  " + rest) == library.encode("  " + rest)
    assert longest[0] <= 300  # the runs of blanks above
    assert model.encode(" " * 100_000 + "x") == library.encode(" " * 100_000 + "x")


@pytest.mark.parametrize("unit, n", [("abcdefghij", 30_000), ("the", 20_000), ("漢字x", 20_000)])
def test_window_stays_small(model, library, unit, n):
    text, ids, trace = unit * n, [], []
    model.search(S.BLANK + text, ids, trace)
    assert ids == library.encode(text)
    assert max(live for _, live in trace) <= 2 * model.longest + S._CHECK_EVERY  # boundaries kept


def test_round_trip_in_spark(spark, odd_docs, no_docs):
    out = S.encode(odd_docs)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == 9 and rows[2].round_trip is None and rows[3].n_tokens == 0 and rows[2].n_tokens == 0
    assert all(r.round_trip for r in rows.values() if r.doc_id != 2)
    back = {r.doc_id: r.text for r in S.decode(out).collect()}
    assert back[5] == "x " * 30_000 and back[7] == " \n\t "
    assert S.encode(no_docs).count() == 0
