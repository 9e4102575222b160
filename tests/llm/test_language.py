import random

import numpy as np
import pytest

from relforge.llm import language as L


def test_address():
    assert L.address("https://Blog.Example.ORG:80/fr/12?x#y") == ("blog.example.org", "example.org", "org/fr")
    assert L.address("http://u@h.de/index.html") == ("h.de", "h.de", "de")
    assert L.address("http://h.ch/de-ch/a") == ("h.ch", "h.ch", "ch/de-ch")
    assert L.address(None) == L.address("") == L.address("no address") == ("", "", "")


def made(seed=1):
    """Pages of two languages; short ones say nothing, some declare a wrong language."""
    rng = random.Random(seed)
    words = {"xa": ["foo", "bar", "baz", "quux"], "xb": ["lorem", "ipsum", "dolor", "sit"]}
    docs = [(i, " ".join(rng.choice(words[y]) for _ in range(60)), y) for i in range(200) for y in [("xa", "xb")[i % 2]]]
    pages = []
    for i in range(240):
        y = ("xa", "xb")[i % 2]
        host = f"{y}{i % 6}.{'one' if y == 'xa' else 'two'}.org"
        body = " ".join(rng.choice(words[y]) for _ in range(80)) if i % 8 > 1 else "12"
        declared = y if i % 16 else ("xb" if y == "xa" else "xa")
        pages.append((i, f"https://{host}/{y}/{i}", f'<html lang="{declared}"><body><p>{body}. {body}.</p></body></html>', y))
    return docs, pages


def test_fusion(spark):
    docs, pages = made()
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, truth string")
    model = L.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model.languages == ["xa", "xb"]
    rows = {r.page_id: r for r in L.identify(frame, model).collect()}
    assert len(rows) == len(pages)
    # the text decides where there is one; without a text host, suffix and declaration do
    assert all(rows[i].lang == y for i, _, _, y in pages)
    assert all(0.5 <= r.p <= 1 for r in rows.values())
    again = {r.page_id: r for r in L.identify(frame.repartition(5), model).collect()}
    assert all(abs(rows[i].p - again[i].p) < 1e-5 for i in rows)


def brute(rows, model, weights):
    """(text_lang, lang, p) of each page by the formulas, page by page, in plain Python."""
    size = len(model.languages)
    seen = []
    for _, url, html, _ in rows:
        log = model.evidence(L.extract(html, weights))
        post = np.exp(log - log.max())
        m = L._LANG.search(html or "")
        seen.append((*L.address(url), m[1].lower() if m else "", log, post / post.sum()))
    out = []
    for i, (host, domain, suffix, declared, log, _) in enumerate(seen):
        others = [s for k, s in enumerate(seen) if k != i]

        def soft(place, value):
            held = [s[5] for s in others if s[place] == value]
            return np.sum(held, axis=0) if held else np.zeros(size), len(held)
        everyone = np.sum([s[5] for s in others], axis=0)
        overall = (everyone + 1) / (len(others) + size)
        at_domain, n_domain = soft(1, domain)
        at_host, n_host = soft(0, host)
        prior = (at_host + L.HOST_WEIGHT * (at_domain + L.HOST_WEIGHT * overall) / (n_domain + L.HOST_WEIGHT)) / (n_host + L.HOST_WEIGHT)
        total = log + np.log(prior)
        for place, value in ((3, declared), (2, suffix)):
            counts, n = soft(place, value)
            total = total + np.log((counts + L.SMOOTH * max(n / max(len(others), 1), 1e-3)) / (everyone + L.SMOOTH))
        share = np.exp(total - total.max())
        out.append((model.languages[int(log.argmax())], model.languages[int(total.argmax())], float((share / share.sum()).max())))
    return out


def test_fused_posterior_equals_the_formulas(spark):
    docs, pages = made(4)
    pages = pages[:90] + [(500, None, None, "xa"), (501, "http://lone.net/xb/", "<p>lorem ipsum, bar.</p>", "xb")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, truth string").repartition(4)
    model = L.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    weights = L.fit_weights(frame)
    rows = {r.page_id: r for r in L.identify(frame, model, weights=weights).collect()}
    for (i, *_), (text_lang, lang, p) in zip(pages, brute(pages, model, weights)):
        assert (rows[i].lang, rows[i].p) == (lang, pytest.approx(p, abs=1e-5)) and rows[i].text_lang == text_lang, i


def test_text_model_matches_counting(spark):
    docs, _ = made()
    model = L.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"), max_docs=1000)
    counts = np.zeros((L.BUCKETS, 2))
    for _, t, y in docs:
        np.add.at(counts, (L.buckets(t), ("xa", "xb").index(y)), 1)
    assert np.allclose(model.log, L.TextModel(["xa", "xb"], counts).log)


def test_odd_rows(spark, no_docs):
    docs, _ = made()
    model = L.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    pages = spark.createDataFrame([(1, None, None, 1), (None, "", "", 2), (2, "http://h.org/xa/1", "<html lang='xa'>" + "foo bar " * 50_000, 3), (2, "http://h.org/xa/1", "<p>lorem", 4)],
                                  "page_id long, url string, html string, host long")
    rows = L.identify(pages, model).collect()
    assert len(rows) == 4 and all(r.lang in ("xa", "xb") for r in rows)
    assert L.identify(pages.limit(0), model).count() == 0
    unknown = L.identify(pages, L.fit(no_docs)).collect()
    assert len(unknown) == 4 and all(r.lang is None and r.p is None for r in unknown)
