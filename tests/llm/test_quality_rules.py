import re
from collections import Counter

from pyspark.sql import functions as F

from relforge.llm import quality_rules as R
from relforge.llm.common import Scratch


def brute(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0D]+", text) if w]
    found = Counter(zip(words, words[1:], words[2:]))
    under = {k + d for k, w in enumerate(zip(words, words[1:], words[2:])) if found[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(under), n < 50 or 100 * len(under) > 50 * n)


def counts(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_counts_match_brute_force(spark, some_docs, monkeypatch):
    texts = [t for _, t in some_docs] + [None, "", " ", "a\x1cb a b", "a b c a b c", "x x x x", "x x x", "l\nl\n l\n\n\nl", "é#ß|𐍈 <>", "\x0b\x0ca\r\nb"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    for packed in (R._PACKED, 2):  # the second way is that of very long texts
        monkeypatch.setattr(R, "_PACKED", packed)
        got = {r.doc_id: counts(r) for r in R.measure(df).collect()}
        assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_fences_follow_language_and_source(spark):
    """Long words are usual in one source, and far out in the others."""
    def text(i, size, extra=""):
        return " ".join(f"{(i * 37 + k * 11) % 9973:0{size}d}" for k in range(80)) + extra
    rows = [(i, text(i, 5), "en", "plain") for i in range(300)] + [(1000 + i, text(i, 12), "en", "long") for i in range(300)]
    rows += [(2000 + i, text(i, 5), "de", f"s{i % 40}") for i in range(240)]  # small sources: the language's fences
    rows += [(3000, text(1, 12), "en", "plain"), (3001, text(2, 12), "de", "s1"), (3002, text(3, 5, " ###" * 60), "en", "plain"), (3003, text(4, 5), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in R.filter_rules(df).collect()}
    assert len(out) == len(rows)
    bad = {i for i, r in out.items() if not r.kept}
    assert bad == {3000, 3001, 3002}
    assert out[3000].broken_rules == ["word_length"] and "symbol_share" in out[3002].broken_rules
    levels = {(r.f_lang, r.f_source): r.level for r in R.fences(R.measure(df), Scratch(spark, "test")).collect()}
    assert levels["en", "plain"] == "source" and levels["de", "s1"] == "lang" and levels[None, None] == "all"


def test_upper_fences_follow_the_tail(spark):
    """Symbols, repeated lines and repeated words are usual in one source; some junk in the other widens nothing."""
    def text(i, symbols=0, lines=0, again=0):
        words = [f"{(i * 37 + k * 11) % 9973:05d}" for k in range(100)]
        own = [" ".join(words[k : k + 5]) for k in range(0, 100, 5)]
        return "\n".join([*own, *["|" * symbols] * bool(symbols), *["same"] * lines, " ".join(words[:again])])
    rows = [(i, text(i), "en", "plain") for i in range(300)]
    rows += [(1000 + i, text(i, i % 60, i % 15, i % 30), "en", "code") for i in range(300)]
    rows += [(2000 + i, text(i, 290), "en", "plain") for i in range(24)]
    rows += [(3000 + i, text(7, *x), "en", s) for i, (s, x) in enumerate((s, x) for s in ("plain", "code") for x in ((40, 0, 0), (0, 13, 0), (0, 0, 33)))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    limit = {r.f_source: r for r in R.fences(R.measure(df), Scratch(spark, "tails")).collect()}
    for m in ("symbol_share", "dup_line_share", "repeat_share"):
        assert limit["plain"][m + "_high"] < 0.25 < limit["code"][m + "_high"], m
    out = {r.doc_id: r for r in R.filter_rules(df).collect()}
    assert {i for i, r in out.items() if not r.kept} == {*range(2000, 2024), 3000, 3001, 3002}
    assert [out[3000 + i].broken_rules for i in range(3)] == [["symbol_share"], ["dup_line_share"], ["repeat_share"]]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = R.filter_rules(odd_docs).collect()
    assert len(rows) == 9
    by = {r.doc_id: r for r in rows}
    assert by[2].base_failed and not by[2].kept and by[2].n_words == 0
    assert by[5].n_words == by[5].n_repeat_words == 30_000
    assert R.filter_rules(no_docs).count() == 0


def test_plan_has_no_python(odd_docs):
    plan = R.measure(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
