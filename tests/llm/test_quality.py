import random

import numpy as np

from relforge.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy():
    """Fit on three quarters of the labels of a given table, judge the rest."""
    import duckdb
    rows = duckdb.connect().execute(f"""SELECT text, CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END
        FROM '/root/testdata/sf0.1/documents.parquet' d JOIN '/root/testdata/sf0.1/labels.parquet' l USING (doc_id) ORDER BY hash(d.doc_id)""").fetchall()
    test, train = rows[: len(rows) // 4], rows[len(rows) // 4 :]
    grades = [g for _, g in train]
    model = Q.fit_sample(Q.Sample.of([(g, Q.features(t)) for t, g in train]), {g: float(grades.count(g)) for g in range(3)})
    assert model.thresholds[0] < model.thresholds[1]
    scorer = Q._Scorer(model)
    tails = model.tails(np.array([scorer.score(t) for t, _ in test]))
    y = np.array([g for _, g in test])
    kept = tails[:, 1] >= Q.KEEP_AT
    assert kept[y == 2].mean() > 0.985 and kept[y == 0].mean() < 0.02 and kept[y == 1].mean() < 0.25
    assert (tails[:, 0] >= tails[:, 1]).all()
    expected = tails.sum(axis=1)
    assert expected[y == 0].mean() < expected[y == 1].mean() < expected[y == 2].mean()


def test_scorer_is_the_sum_of_features():
    model = Q.OrdinalModel(np.random.default_rng(1).normal(size=Q.BUCKETS).astype(np.float32), np.array([-1.0, 1.0]))
    scorer = Q._Scorer(model)
    for text in ["", None, "A few WORDS few words\nagain\nagain", "x " * 500]:
        assert abs(scorer.score(text) - float(sum(model.weights[b] for b in Q.features(text)))) < 1e-3


def test_thresholds_fit_a_known_model():
    rng = np.random.default_rng(2)
    score = rng.normal(0, 3, 20_000)
    tails = 1 / (1 + np.exp(np.array([[-2.0, 1.5]]) - score[:, None]))
    grade = (rng.random(20_000)[:, None] < tails).sum(axis=1)
    assert np.allclose(Q._thresholds(score, grade, np.ones(20_000), np.array([0.0, 0.1])), [-2.0, 1.5], atol=0.15)


def test_in_spark(spark, odd_docs, no_docs):
    rng = random.Random(1)
    words = [f"word{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(60)) + (" awful" if i % 4 == 1 else "")) for i in range(400)]
    docs = [(i, "### " * 40 if i % 4 == 2 else t) for i, t in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 2 else 1, 1 if i % 4 == 1 else 0) for i in range(300)] + [(None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = Q.fit(frame, labels)
    rows = {r.doc_id: r for r in Q.rate(frame, model).collect()}
    assert len(rows) == 400
    right = sum(rows[i].kept == (i % 4 in (0, 3)) for i in range(300, 400))
    assert right >= 97
    again = Q.fit(frame.repartition(7), labels.repartition(3))
    assert np.allclose(model.weights, again.weights) and np.allclose(model.thresholds, again.thresholds)
    assert Q.rate(odd_docs, model).count() == 9
    kept = Q.keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() <= 9
    assert Q.keep_good(no_docs, model).count() == 0
    nothing = Q.fit(no_docs, labels.limit(0))
    assert all(r.kept for r in Q.rate(odd_docs, nothing).collect())
