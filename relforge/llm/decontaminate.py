"""Benchmark decontamination by BM25 retrieval with block-max WAND (operator 1).

The test items are the indexed side: they are cut into units of at most 48 words, which go into a BM25
inverted index with block maxima. The training side is the stream of queries: every document, whole,
is cut into passages of 96 words that overlap by half, so each run of 48 words lies in some passage.

A hit is verified on the words around the passage: at least half of the 3-word shingles of the whole item must be there, wherever it was
cut or edited. Where an item has an answer of its own (an answer column, or a last sentence that says "answer is" or "answer:"), at least half
of the question's shingles and half of the answer's words must be there instead. Items shorter than 8 words must
occur as one unbroken run of words.

Retrieval loses nothing that this rule accepts: each unit has a threshold of its own, the least share of its full score that its
words can have in a text that passes the rule (``least_share``: half of the shingles, made of the words that weigh least, over the units of the item). What lies within 48 words of a
text for each unit, as any unbroken part does, is found. BM25 statistics
are those of all units, counted by one grouped aggregate, so that scores and hits depend neither on how items fall into blocks
of the index nor on units of similar length sharing a part of it (``TIERS``: a frequent word weighs much in a short unit and would loosen the bounds
of the long ones). A passage's first WAND test (the sum of its terms' upper bounds) is made for a whole batch at once; passages that
pass it go through block-max WAND, which returns every unit that reaches its threshold.

Words are runs of letters and digits, in lower case. Without an answer column the last sentence of an
item's text (in a one-sentence item, its last quarter) counts as its answer in ``answer_overlap``; it vetoes
nothing unless it is marked as the answer.

Items are few against documents, but they are not trusted to be: the index is built and broadcast in
blocks of at most ``MAX_BLOCK_BYTES`` of item text, each block being matched against all documents. Defined results: a null or
empty text, of a document or an item, matches nothing; an empty table gives no rows; rows that repeat are reported each; ids may be
null; extra columns are ignored. No document or passage is skipped, whatever its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bm25_wand import BlockMaxIndex, Weights
from .common import col, free_name, slices

UNIT, PASSAGE = 48, 96
LEAST_OVERLAP = 0.5
TIERS = (12, 24, UNIT)
SHORT_ITEM = 8
MAX_BLOCK_BYTES = 4_000_000

_SEPARATE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: UTF-8 of U+00A0-00BF and U+2000-206F without U+00AA, U+00B2-B3, B5, B9-BA, BC-BE: blanks and marks beyond ASCII.
_MARKS = re.compile(rb"\xc2[\xa0-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf]|\xe2[\x80\x81][\x80-\xbf]|\xe3\x80[\x80-\x82]")


#: A last sentence that says that it is the answer.
_ANSWER = re.compile(r"\W*(?:(?:so|the|correct|right|final) )*answer(?: is\b|\s*:)", re.IGNORECASE)


def words_of(text: str | None) -> list[bytes]:
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    if b"\xe2" in raw or b"\xc2" in raw or b"\xe3" in raw:
        raw = _MARKS.sub(b" ", raw)
    return raw.translate(_SEPARATE).split()


def _sentences(text: str) -> list[str]:
    return [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if words_of(p)]


def has_answer(text: str) -> bool:
    """Whether the last of several sentences is marked as the answer."""
    parts = _sentences(text)
    return len(parts) > 1 and _ANSWER.match(parts[-1]) is not None


def split_item(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer words: the last sentence with a word is the answer, else the last quarter."""
    parts = [words_of(p) for p in _sentences(text)]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    found = parts[0] if parts else []
    cut = len(found) - max(1, len(found) // 4) if len(found) > 1 else len(found)
    return found[:cut], found[cut:]


def _grams(found: list[bytes], n: int = 3) -> set:
    if len(found) < n:  # the whole run
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(n)), strict=False))


def cut_units(whole: list[bytes]) -> list[list[bytes]]:
    """An item's words in units of about equal length, at most ``UNIT`` each."""
    step = -(-len(whole) // -(-len(whole) // UNIT)) if whole else 1
    return [whole[i : i + step] for i in range(0, len(whole), step)]


def _half(found: set) -> int:
    return -(-len(found) // 2)


def lightest(weights: list[float], grams: int) -> float:
    """The least weight of a choice of positions that holds ``grams`` runs of three: by position, over the two choices before it."""
    if grams <= 0:
        return 0.0
    if grams > len(weights) - 2:
        return float(sum(weights))
    # best[a][b][j]: least weight where the last two positions are left out (0) or taken (1), and j runs are complete
    best = np.full((2, 2, grams + 1), np.inf)
    best[0, 0, 0] = 0.0
    for w in weights:
        after = np.empty_like(best)
        after[:, 0] = np.minimum(best[0], best[1])
        taken = np.minimum(best[0], best[1]) + w
        after[0, 1] = taken[0]
        whole = best[1, 1] + w  # a third one in a row: one run more, and not beyond what is asked for
        longer = np.concatenate([[np.inf], whole[:-1]])
        longer[-1] = min(longer[-1], whole[-1])
        after[1, 1] = np.minimum(best[0, 1] + w, longer)
        best = after
    return float(best[:, :, -1].min())


def least_share(question: list[bytes], answer: list[bytes], own_answer: bool, impacts: list[dict[bytes, float]]) -> float:
    """The share of its full score that at least one unit of an item reaches in any text that passes the rule.

    The least sum of shares over all units that half of the shingles can have, divided by the number of units.
    """
    whole = question + answer
    units = cut_units(whole)
    if len(whole) < SHORT_ITEM:
        return 1.0 - 1e-9  # all of its words
    # a word's weight counts once in a unit, however often it stands there
    weights = [x[w] / unit.count(w) for unit, x in zip(units, impacts, strict=True) for w in unit]
    if not own_answer:
        least = lightest(weights, _half(_grams(whole)))
    elif len(question) >= 3:
        least = lightest(weights[: len(question)], _half(_grams(question)))
    else:
        least = sum(weights[: len(question)]) / 2
    if own_answer:  # and half of the answer's words, of which those of the question may be there already
        of = {w: sum(x.get(w, 0.0) for x in impacts) for w in set(answer) - set(question)}
        missing = _half(set(answer)) - len(set(answer) & set(question))
        least += sum(sorted(of.values())[: max(0, missing)])
    return min(max(least / len(units) - 1e-9, 1e-3), 1.0 - 1e-9)


class _Matcher:
    """Finds verified (item, scores) for the documents of a batch against one block of items."""

    def __init__(self, items: list[tuple], weights: Weights):
        self.ids, self.question, self.answer, self.whole, self.size, self.run = [], [], [], [], [], []
        tiers: list[tuple[list, list, list]] = [([], [], []) for _ in TIERS]
        for item_id, question, answer in items:
            q, a = (words_of(question), words_of(answer)) if answer is not None else split_item(question or "")
            whole = q + a
            if not whole:
                continue
            k = len(self.ids)
            own_answer = answer is not None or has_answer(question or "")
            self.ids.append(item_id)
            self.question.append(_grams(q))
            self.answer.append(set(a))
            self.whole.append(None if own_answer else _grams(whole))
            self.size.append(len(whole))
            self.run.append(b" " + b" ".join(whole) + b" " if len(whole) < SHORT_ITEM else None)
            units = cut_units(whole)
            shares = [weights.impacts(u) for u in units]
            least = least_share(q, a, own_answer, shares)
            for unit, impacts in zip(units, shares, strict=True):
                for held, value in zip(tiers[next(t for t, most in enumerate(TIERS) if len(unit) <= most)], (impacts, least, k), strict=True):
                    held.append(value)
        self.terms = {w: t for t, w in enumerate(dict.fromkeys(w for impacts, _, _ in tiers for x in impacts for w in x))}
        self.tiers = []  # index, owners of its units, its term of each term, bound of each term
        for impacts, least, owners in tiers:
            if impacts:
                index = BlockMaxIndex(impacts, least)
                local = np.full(len(self.terms), -1, np.int32)
                local[[self.terms[w] for w in index.term_of]] = list(index.term_of.values())
                bound = np.where(local >= 0, index.bound[local], 0.0)
                self.tiers.append((index, owners, local, bound))

    def _verify(self, k: int, found: list[bytes], start: int) -> tuple[float, float] | None:
        region = found[max(0, start - self.size[k]) : start + PASSAGE + self.size[k]]
        if self.run[k] is not None:
            return (1.0, 1.0) if self.run[k] in b" " + b" ".join(region) + b" " else None
        n = len(next(iter(self.question[k]), ()))  # 3, or fewer for a shorter question
        whole = self.whole[k]  # None: the item has an answer of its own
        if whole and len(whole & (found_grams := _grams(region))) < LEAST_OVERLAP * len(whole):
            return None
        q = len(self.question[k] & (found_grams if whole and n == 3 else _grams(region, n))) / len(self.question[k]) if n else 1.0
        a = len(self.answer[k] & set(region)) / max(1, len(self.answer[k]))
        return (q, a) if whole or min(q, a) >= LEAST_OVERLAP else None

    def match(self, texts: list[str | None]) -> list[tuple]:
        """(row, item id, score, question overlap, answer overlap) of the batch's documents."""
        lookup, absent = self.terms.get, repeat(-1)
        docs = [words_of(t) for t in texts]
        # each document gets whole half-passages of its own, the last one empty
        halves = [max(1, -(-(len(d) - PASSAGE) // UNIT) + 1) + 1 for d in docs]
        first = np.concatenate([[0], np.cumsum(halves)]).astype(np.int64)
        ids = np.full(int(first[-1]) * UNIT, -1, np.int32)
        for d, at in zip(docs, first, strict=False):
            if d:
                ids[at * UNIT : at * UNIT + len(d)] = list(map(lookup, d, absent))
        known = np.flatnonzero(ids >= 0)
        if not len(known):
            return []
        keys = ids[known] if len(self.terms) > 65_535 else ids[known].astype(np.uint16)  # 16 bits sort fastest
        order = known[np.argsort(keys, kind="stable")]
        same = np.zeros(len(order), bool)
        same[1:] = ids[order[1:]] == ids[order[:-1]]
        before = np.full(len(order), -9, np.int64)
        before[1:][same[1:]] = order[:-1][same[1:]] // UNIT
        half, n = order // UNIT, int(first[-1])
        fresh, fresher = before < half, before < half - 1
        best: dict[tuple, tuple] = {}
        for index, owners, local, bound in self.tiers:
            weight = bound[ids[order]]
            cap = np.bincount(half, weight * fresh, n)
            cap[:-1] += np.bincount(half, weight * fresher, n)[1:]
            cap[first[1:] - 1] = 0  # no passage starts in a document's last half
            for p in np.flatnonzero(cap >= 1.0 - 1e-9):
                here = ids[p * UNIT : p * UNIT + PASSAGE]
                terms = np.unique(local[here[here >= 0]])
                for unit, reached in index.search(terms[terms >= 0].tolist(), 1.0):
                    row, k, score = int(np.searchsorted(first, p, "right")) - 1, owners[unit], reached * index.threshold[unit]
                    if best.get((row, k), (0.0,))[0] >= score:
                        continue
                    over = self._verify(k, docs[row], int(p - first[row]) * UNIT)
                    if over:
                        best[row, k] = (score, *over)
        return [(row, self.ids[k], *found) for (row, k), found in sorted(best.items())]


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                 item_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every document that holds an item.

    With ``answer_col`` the item column is the question; without it the whole text is the item, and is split for
    the overlaps.
    """
    spark = docs.sparkSession
    given = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    answer = col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    tests = items.select(col(item_id_col).cast("long").alias("item_id"), col(item_col).cast("string").alias("q"), answer.alias("a"))
    tests = tests.where("q is not null or a is not null")
    size = tests.select(F.sum(F.octet_length(F.concat(F.coalesce("q", F.lit("")), F.coalesce("a", F.lit("")))) + 16)).first()[0] or 0
    blocks = 1 + size // MAX_BLOCK_BYTES
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"

    tests = tests.withColumn("block", F.pmod(F.xxhash64("item_id", "q", "a"), F.lit(blocks)))

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for q, a, block in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                whole = [w for part in ((words_of(q), words_of(a)) if a is not None else split_item(q or "")) for w in part]
                found += [(block, list(dict.fromkeys(u)), len(u)) for u in cut_units(whole)]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.list_(pa.binary()), pa.int64()))],
                                             ["block", "words", "size"])

    cut = tests.select("q", "a", "block").mapInArrow(units, "block long, words array<binary>, size long")
    n, total = cut.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    held = cut.select("block", F.explode("words").alias("word"))
    counts = held.groupBy("word").agg(F.count(F.lit(1)).alias("units"))  # a word stands in a unit once here

    def block(k: int) -> DataFrame:
        mine = tests.where(F.col("block") == k).drop("block").orderBy("item_id", "q", "a")
        own = counts if blocks == 1 else counts.join(held.where(F.col("block") == k).select("word").distinct(), "word", "left_semi")
        weights = Weights(n, total / max(1, n), {bytes(r["word"]): r["units"] for r in own.collect()})  # words of one block of items
        shared = spark.sparkContext.broadcast(([tuple(r) for r in mine.collect()], weights))

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = None
            for batch in slices(batches):
                matcher = matcher or _Matcher(*shared.value)
                rows = matcher.match(batch.column(1).to_pylist())
                ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                rest = [pa.array([r[i] for r in rows], t) for i, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64()), (4, pa.float64()))]
                yield pa.RecordBatch.from_arrays([ids, *rest], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        return given.mapInArrow(found, schema)

    out = block(0)
    for k in range(1, blocks):
        out = out.unionByName(block(k))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without the documents that hold a test item (null ids stay)."""
    own = free_name(docs, "_bad_id")
    bad = contaminated(docs, items, id_col, text_col).select(F.col("doc_id").alias(own)).distinct()
    return docs.join(bad, col(id_col).cast("long") == F.col(own), "left_anti")
