"""Each stage of the pipeline against a plain form of its decision, on a given table."""

import duckdb

import corpus_pipeline
from relforge.llm import decontaminate, pii, quality
from relforge.llm.common import Scratch, read_table
from relforge.llm.sentencepieces import PieceModel

from .test_near_dup import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    scratch = Scratch(spark, "test-pipeline")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = scratch.stage(stage(spark, docs, SF), name)
        assert docs.columns == before.columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert len(kept[name]) == docs.count()
    given = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    model = quality.fit(read_table(spark, SF, "documents"), read_table(spark, SF, "labels"))
    scorer = quality._Scorer(model)
    good = {i for i, t in given.items() if model.tails([scorer.score(t)])[0, -1] >= quality.KEEP_AT}
    assert set(kept["quality"]) == good
    first = {i for i, (_, c) in brute(sorted(kept["quality"].items())).items() if i == c}
    assert set(kept["near_duplicates"]) == first
    items = duckdb.connect().execute(f"select text from '{SF}/benchmark.parquet'").fetchall()
    clean = {i for i, t in kept["near_duplicates"].items() if not any(b.lower() in t.lower() for b, in items)}
    assert set(kept["decontamination"]) == clean
    assert set(kept["pii"]) == clean
    same = {i for i, t in kept["pii"].items() if t == given[i]}
    assert all(t == given[i] for i, t in kept["pii"].items() if not any(c.isdigit() or c == "@" for c in given[i])) and same != clean
    ids = {r.doc_id: r.ids for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    pieces = PieceModel()
    assert all(pieces.decode(ids[i]) == t and pieces.encode(t) == ids[i] for i, t in kept["pii"].items()) and set(ids) == clean
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()} == ids


def test_empty_and_odd_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = Scratch(spark, "test-odd").stage(stage(spark, docs, SF), name)
    assert docs.columns == ["doc_id", "n_tokens", "ids", "round_trip"]


def test_modules_are_those_of_the_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None and decontaminate and pii
