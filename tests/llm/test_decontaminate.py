import random
from collections import Counter

import pyarrow.parquet as pq

from relforge.llm import decontaminate as D
from relforge.llm.bm25_wand import BlockMaxIndex, Weights

SF = "/root/testdata/sf0.001"


def test_wand_finds_what_scoring_all_finds():
    rng = random.Random(4)
    vocabulary = [f"w{min(int(rng.expovariate(0.02)), 400)}".encode() for _ in range(3000)]
    units = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))] for _ in range(300)]
    weights = Weights.of(units)
    index = BlockMaxIndex([weights.impacts(u) for u in units], [rng.choice([0.3, 1.0]) for _ in units])
    for with_table in (True, False):
        index.table = index.table if with_table else None
        for _ in range(60):
            terms = sorted({index.term_of[w] for w in (rng.choice(vocabulary) for _ in range(30)) if w in index.term_of})
            score = Counter()
            for t in terms:
                for u, x in zip(index.units[t], index.impacts[t]):
                    score[u] += x
            for least in (0.05, 0.2, 0.5):
                want = {u for u, x in score.items() if x >= least + 1e-9}
                got = dict(index.search(terms, least))
                assert want <= set(got) and all(abs(got[u] - score[u]) < 1e-9 for u in got)


def test_finds_every_planted_item(spark, some_docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    wanted = {(i, r.item_id) for r in items.collect() for i, t in some_docs if r.text.lower() in (t or "").lower()}
    got = D.contaminated(spark.read.parquet(f"{SF}/documents.parquet"), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == wanted and len(got) == len(wanted)


def test_edits_partial_and_long(spark):
    rng = random.Random(5)
    fill = lambda n: " ".join(f"f{rng.randrange(10_000)}" for _ in range(n))
    item = " ".join(f"q{i}" for i in range(30)) + ". The answer is " + " ".join(f"a{i}" for i in range(6)) + "."
    long_item = " ".join(f"z{i}" for i in range(300)) + ". Final words z900 z901."
    words = item.split()
    words[3] = words[17] = "changed"
    docs = [(1, fill(500) + " " + item.upper() + " " + fill(70)), (2, fill(333) + " " + " ".join(words) + " " + fill(10)),
            (3, fill(40) + " " + item.split(".")[0] + " " + fill(90)),  # the question without its answer
            (4, fill(3000)), (5, fill(97) + long_item + fill(5)), (6, "Say hello world now and more " + fill(5)), (7, "hello big world " + fill(5))]
    items = [(10, item), (11, long_item), (12, "Hello world now."), (13, None), (14, "")]
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 10), (2, 10), (5, 11), (6, 12)}


def test_items_cut_or_edited_at_the_end(spark):
    """Without an answer column the end of an item is no answer: what holds the rest is a hit."""
    rng = random.Random(6)
    fill = lambda n: " ".join(f"f{rng.randrange(10_000)}" for _ in range(n))
    two, one = " ".join(f"q{i}" for i in range(37)), [f"s{i}" for i in range(40)]
    long_end = " ".join(f"u{i}" for i in range(30)) + ". " + " ".join(f"v{i}" for i in range(12)) + "."
    items = [(10, two + ". Er."), (11, " ".join(one) + "."), (12, long_end)]
    docs = [(1, fill(60) + " " + two + " " + fill(80)), (2, fill(60) + " " + two + ". Other. " + fill(80)), (3, fill(9) + " " + " ".join(one[:30]) + " " + fill(80)),
            (4, fill(9) + " " + " ".join(one[10:]) + " " + fill(80)), (5, fill(50) + long_end.split(".")[0] + ". " + fill(80)), (6, fill(50) + " " + " ".join(one[:12]) + " " + fill(80))]
    spread = lambda found: {(r.doc_id, r.item_id) for r in found.collect()}
    given, tests = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert spread(D.contaminated(given, tests)) == {(1, 10), (2, 10), (3, 11), (4, 11), (5, 12)}
    assert spread(D.decontaminate(given, tests).selectExpr("doc_id", "0L item_id")) == {(6, 0)}
    # a real answer has to be there
    split = spark.createDataFrame([(10, two, "Er."), (11, " ".join(one[:30]), " ".join(one[30:]))], "item_id long, text string, answer string")
    assert spread(D.contaminated(given, split, answer_col="answer")) == {(4, 11)}
    assert D.has_answer("What is it? The answer is four.") and D.has_answer("What?\nAnswer: 4") and not D.has_answer("Answer: 4") and not D.has_answer("It is so. Answers vary.")


def test_least_weight_of_half_of_the_shingles():
    """Against every choice of positions."""
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randrange(3, 11)
        weights = [rng.random() for _ in range(n)]
        for grams in range(n):
            fits = [sum(w for i, w in enumerate(weights) if c >> i & 1) for c in range(1 << n)
                    if sum(c >> i & 7 == 7 for i in range(n - 2)) >= grams]
            assert abs(D.lightest(weights, grams) - min(fits, default=sum(weights))) < 1e-9


def test_every_text_that_passes_the_rule_is_found():
    """All items of sf0.1, cut to 55-80 % or with 10-20 % of their words changed: what holds half of the shingles is a hit."""
    items = [(r["item_id"], r["text"], None) for r in pq.read_table("/root/testdata/sf0.1/benchmark.parquet").to_pylist()]
    units = [u for _, t, _ in items for u in D.cut_units([w for part in D.split_item(t) for w in part])]
    matcher = D._Matcher(items, Weights.of(units))
    rng = random.Random(11)
    fill = lambda n: [f"f{rng.randrange(10_000)}" for _ in range(n)]
    texts, wanted = [], []
    for k, (item_id, text, _) in enumerate(items):
        for kind in (0.55, 0.6, 0.7, 0.8, "a", "b", "c"):
            found = text.split()
            if isinstance(kind, float):
                first = rng.choice([0, int(len(found) * (1 - kind))])
                found = found[first : first + int(len(found) * kind + 0.5)]
            else:
                for i in rng.sample(range(len(found)), int(len(found) * {"a": 0.1, "b": 0.15, "c": 0.2}[kind])):
                    found[i] = f"z{i}"
            found = " ".join(fill(rng.randrange(200)) + found + fill(rng.randrange(200)))
            if matcher.whole[k] and matcher.run[k] is None and 2 * len(matcher.whole[k] & D._grams(D.words_of(found))) >= len(matcher.whole[k]):
                texts.append(found)
                wanted.append(item_id)
    got = {(row, item_id) for row, item_id, *_ in matcher.match(texts)}
    assert len(wanted) > 1200 and all((row, item_id) in got for row, item_id in enumerate(wanted))


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    """Items that share most of their words, so that weights would differ from block to block."""
    common = [f"c{i}" for i in range(30)]
    rng = random.Random(3)
    items = [(i, " ".join(rng.sample(common, 20) + [f"own{i}x{j}" for j in range(6)])) for i in range(120)]
    docs = [(i, " ".join([f"f{j}" for j in range(40)] + t.split()[: 14 + i % 12] + [f"g{j}" for j in range(60)])) for i, t in items]
    given, tests = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = sorted(map(tuple, D.contaminated(given, tests).collect()))
    assert len(found) > 60
    monkeypatch.setattr(D, "MAX_BLOCK_BYTES", 4_000)
    for (a, b) in zip(found, sorted(map(tuple, D.contaminated(given, tests).collect())), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9
    alone = D.contaminated(given, tests.filter("item_id = 5")).collect()
    assert {r.doc_id for r in alone} == {d for d, i, *_ in found if i == 5}


def test_blocks_of_items_give_the_same(spark, monkeypatch, some_docs):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()}
    monkeypatch.setattr(D, "MAX_BLOCK_BYTES", 3_000)
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()} == whole


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "equal rows are here twice and more than that"), (None, None), (2, "")], "item_id long, text string")
    assert D.decontaminate(odd_docs, items).columns == odd_docs.columns
    exact = spark.createDataFrame([(1, "equal rows are here twice and more")], "item_id long, text string")
    assert [r.doc_id for r in D.contaminated(odd_docs, exact).collect()] == [6, 6]
    assert D.decontaminate(odd_docs, exact).count() == 7
    assert D.contaminated(no_docs, items).count() == 0
    assert D.contaminated(odd_docs, items.limit(0)).count() == 0
