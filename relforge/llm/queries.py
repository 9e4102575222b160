"""The registered queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe
from .common import read_table
from .decontaminate import contaminated
from .html_extract import extract_pages
from .html_extract import fit as fit_html
from .language import fit as fit_language
from .language import identify
from .near_dup import near_duplicates
from .oracles import near_dup_sql, vector_codes_sql
from .pii import pseudonymize
from .quality import fit, rate
from .quality_rules import filter_rules
from .sentencepieces import encode
from .substring_dedup import remove_repeats
from .token_counts import edited_counts
from .vector_codes import code_table
from .whitening import whitened_table

ORACLE_SQL: dict[str, str] = {"op4_near_dup": near_dup_sql(), "op11_vector_codes": vector_codes_sql()}


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text with pseudonyms, kinds found."""
    return pseudonymize(read_table(spark, sf_dir, "documents").select("doc_id", "text"), found_col="kinds")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read_table(spark, sf_dir, "documents"))


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after the edits of a cleaning pass."""
    return edited_counts(read_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return rate(docs, fit(docs, read_table(spark, sf_dir, "labels")))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return extract_pages(pages, fit_html(pages))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_rules(read_table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "pages"), fit_language(read_table(spark, sf_dir, "documents")))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_table(read_table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_table(read_table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of each text, and of the bytes that they decode to."""
    return byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(read_table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_pii": op2_pii,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_near_dup": op4_near_dup,
    "op5_token_counts": op5_token_counts,
    "op6_quality": op6_quality,
    "op7_html": op7_html,
    "op8_rules": op8_rules,
    "op9_language": op9_language,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_whitening": op12_whitening,
    "op13_byte_bpe": op13_byte_bpe,
}
