"""Ordinal quality classifier: cumulative links over shared hashed-text weights (operator 6).

Ratings are graded 0 (low quality), 1 (toxic), 2 (clean). One linear score s(x) serves all grades, and
ordered thresholds t1 < t2 turn it into P(grade >= k) = 1 / (1 + exp(t_k - s)). The expected grade is the
sum of these tail probabilities; a document is kept if the tail probability of the top grade is at
least ``KEEP_AT``.

The score is a sum over the distinct words of the whole text (a weight for the word, and for its first
four and five characters) and over a few coarse shape marks (share of distinct words, repeats, capitals,
symbols, repeated lines, length), all hashed into ``BUCKETS`` weights.

Fitting. ``fit`` takes at most ``MAX_PER_GRADE`` labelled documents of each grade (those with the
smallest hash of their id), equal texts once, and weighs each grade back to its share of all labels. Only
features that a lower grade holds in a small share of its texts at least, and significantly more often
than the top grade, get a weight, besides the shape marks: ordinary words would only add a drift that
grows with the length of a text. The cumulative-link loss is
minimised with AdaGrad and an L2 penalty on four fifths of the sample; on the last fifth, whose scores
are not fitted, the thresholds are set anew by Newton steps with every grade at its share of all labels.
That bound is a parameter; all else covers all data. The model is ``BUCKETS`` floats, whatever the corpus, so it is sent to the executors as it is.

Defined results: a null or empty text has only its length mark and is scored by it; label rows with a
null are not used; without any label of two grades every document gets grade 2 (nothing is known
against it); rows repeat as given; extra columns are carried or ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, slices

BUCKETS = 1 << 18
MAX_PER_GRADE = 8_000
MIN_DOCS, MIN_SHARE, MIN_Z, MIN_RATIO = 3, 0.002, 3.0, 2.0
EPOCHS, RATE, L2 = 20, 0.5, 1e-5
KEEP_AT = 0.7
GRADES = 3
_CAPITALS, _SYMBOLS = bytes(range(65, 91)), b"#*$%&|<>!{}"
_CACHE_LIMIT = 200_000


def _bucket(mark: str) -> int:
    return zlib.crc32(mark.encode("utf-8", "surrogatepass")) % BUCKETS


def _word_buckets(word: str) -> list[int]:
    out = [_bucket(word)]
    if len(word) > 4:
        out.append(_bucket(word[:4] + "\x01"))
    if len(word) > 5:
        out.append(_bucket(word[:5] + "\x01"))
    return out


def _step(share: float, levels: tuple) -> int:
    return sum(share >= x for x in levels)


_SHARES = (0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)


_NAMES = ("distinct", "again", "capitals", "symbols", "lines")
_ALL_MARKS = [f"\x00{k}{i}" for k in _NAMES for i in range(len(_SHARES) + 1)] + [f"\x00length{i}" for i in range(8)]


def marks(text: str, found: list[str], distinct: int) -> list[str]:
    """Coarse shape marks of a text."""
    n, raw = len(found), text.encode("utf-8", "surrogatepass")
    size = max(1, len(raw))
    lines = [x for x in text.split("\n") if x.strip()]
    shares = (
        distinct / max(1, n) if n >= 30 else 1.0,
        sum(map(eq, found, found[1:])) / max(1, n),
        1 - len(raw.translate(None, _CAPITALS)) / size,
        1 - len(raw.translate(None, _SYMBOLS)) / size,
        1 - len(set(lines)) / max(1, len(lines)),
    )
    return [f"\x00{k}{_step(v, _SHARES)}" for k, v in zip(_NAMES, shares, strict=True)] + [f"\x00length{min(n, 64).bit_length()}"]


@dataclass
class OrdinalModel:
    weights: np.ndarray  # BUCKETS floats
    thresholds: np.ndarray  # ascending, GRADES - 1

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. GRADES - 1, a row for each score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(score)[:, None], -50, 50)))


class _Scorer(dict):
    """word -> its share of the score, remembered."""

    def __init__(self, model: OrdinalModel):
        super().__init__()
        self.weights = model.weights

    def __missing__(self, word: str) -> float:
        if len(self) > _CACHE_LIMIT:
            self.clear()
        value = self[word] = float(sum(self.weights[b] for b in _word_buckets(word)))
        return value

    def score(self, text: str | None) -> float:
        text = text or ""
        found = text.lower().split()
        distinct = set(found)
        return sum(map(self.__getitem__, distinct)) + float(sum(self.weights[_bucket(m)] for m in marks(text, found, len(distinct))))


def features(text: str | None) -> list[int]:
    text = text or ""
    found = text.lower().split()
    distinct = set(found)
    return [b for w in distinct for b in _word_buckets(w)] + [_bucket(m) for m in marks(text, found, len(distinct))]


@dataclass
class Sample:
    """Feature buckets of rated documents, one after the other: row i has ids[at[i] : at[i + 1]]."""

    grade: np.ndarray
    at: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, list[int]]]) -> Sample:
        sizes = [len(x) for _, x in rows]
        flat = np.fromiter((b for _, x in rows for b in x), np.int32, sum(sizes))
        return cls(np.array([g for g, _ in rows], np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), flat)

    def pick(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of some rows, and how many each has."""
        sizes = (self.at[1:] - self.at[:-1])[rows]
        start = np.repeat(self.at[rows] - (np.cumsum(sizes) - sizes), sizes)
        return self.ids[start + np.arange(int(sizes.sum()))], sizes


def _held(sample: Sample) -> np.ndarray:
    """Documents of each grade that hold each bucket."""
    held = np.zeros((GRADES, BUCKETS))
    for i, g in enumerate(sample.grade.tolist()):
        held[g, np.unique(sample.ids[sample.at[i] : sample.at[i + 1]])] += 1
    return held


def _telling(held: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Which buckets get a weight: shape marks, and what a lower grade has more often than the top grade."""
    use = np.zeros(BUCKETS, bool)
    top = (held[-1] + 0.5) / (seen[-1] + 1)
    for g in range(GRADES - 1):
        if seen[g]:
            share = (held[g] + 0.5) / (seen[g] + 1)
            both = (held[g] + held[-1] + 1) / (seen[g] + seen[-1] + 2)
            error = np.sqrt(both * (1 - both) * (1 / (seen[g] + 1) + 1 / (seen[-1] + 1)))
            use |= (held[g] >= max(MIN_DOCS, MIN_SHARE * seen[g])) & (share - top > MIN_Z * error) & (share > MIN_RATIO * top)
    use[[_bucket(m) for m in _ALL_MARKS]] = True
    return use


def fit_sample(sample: Sample, share: dict[int, float], use: np.ndarray | None = None) -> OrdinalModel:
    """Fit on a sample; share: number of labels of each grade; use: buckets that get a weight."""
    weights = np.zeros(BUCKETS, np.float32)
    grade = sample.grade
    seen = np.bincount(grade, minlength=GRADES)
    if (seen > 0).sum() < 2:
        return OrdinalModel(weights, np.full(GRADES - 1, -20.0))
    chosen = _telling(_held(sample), seen)[sample.ids] if use is None else use[sample.ids]
    sizes = np.add.reduceat(np.append(chosen, False), sample.at[:-1]) * (np.diff(sample.at) > 0)
    sample = Sample(grade, np.concatenate([[0], np.cumsum(sizes)]), sample.ids[chosen])
    order = np.random.default_rng(6).permutation(len(grade))
    held = len(order) // 5
    rows, apart = order[held:], order[:held]
    mean = sum(share[g] for g in range(GRADES) if seen[g]) / len(grade)
    natural = np.array([share[g] / seen[g] / mean if seen[g] else 0.0 for g in range(GRADES)])
    # the rarer grades keep at least a third of an even share, so that they shape the weights
    even = np.maximum(natural, 0.33 * len(rows) / ((seen > 0).sum() * np.maximum(seen, 1)))
    w, total = np.zeros(BUCKETS), np.full(BUCKETS, 1e-3)
    t, t_total = np.array([-1.0, 1.0]), np.full(GRADES - 1, 1e-1)
    batch = 64
    for epoch in range(EPOCHS):
        for i in range(0, len(rows), batch):
            part = rows[i : i + batch]
            ids, sizes = sample.pick(part)
            row = np.repeat(np.arange(len(part)), sizes)
            scale = 1 / np.sqrt(np.maximum(sizes, 1))
            score = np.bincount(row, w[ids], len(part))
            tail = 1 / (1 + np.exp(np.clip(t[None, :] - score[:, None], -30, 30)))
            upper = np.concatenate([np.ones((len(part), 1)), tail], axis=1)
            lower = np.concatenate([tail, np.zeros((len(part), 1))], axis=1)
            g = grade[part]
            pick = np.arange(len(part))
            up, lo = upper[pick, g], lower[pick, g]
            # d log(up - lo) / ds = 1 - up - lo, since both are logistic in s
            slope = (up + lo - 1) * even[g]
            used, place = np.unique(ids, return_inverse=True)
            step = np.bincount(place, (slope * scale)[row], len(used)) / len(part) + L2 * w[used]
            total[used] += step**2
            w[used] -= RATE * step / np.sqrt(total[used]) / (1 + 0.15 * epoch)
            gap = np.maximum(up - lo, 1e-9)
            dt = np.zeros(GRADES - 1)
            for k in range(GRADES - 1):
                density = tail[:, k] * (1 - tail[:, k])
                sign = np.where(g == k + 1, 1.0, np.where(g == k, -1.0, 0.0))
                dt[k] = (sign * density / gap * even[g]).mean()
            t_total += dt**2
            t = np.sort(t - 0.1 * dt / np.sqrt(t_total))
            t[1] = max(t[1], t[0] + 0.2)
    weights[:] = w
    if len(np.unique(grade[apart])) == (seen > 0).sum():
        ids, sizes = sample.pick(apart)
        scores = np.bincount(np.repeat(np.arange(len(apart)), sizes), w[ids], len(apart))
        t = _thresholds(scores, grade[apart], natural[grade[apart]], t)
    return OrdinalModel(weights, t)


def _thresholds(score: np.ndarray, grade: np.ndarray, weight: np.ndarray, t: np.ndarray) -> np.ndarray:
    """For each k the threshold t_k of P(grade >= k), by damped Newton steps on its logistic loss."""
    t = t.astype(float).copy()
    for k in range(GRADES - 1):
        y = grade > k
        if y.all() or not y.any():
            continue
        for _ in range(60):
            p = 1 / (1 + np.exp(np.clip(t[k] - score, -30, 30)))
            slope, bend = (weight * (p - y)).sum(), (weight * p * (1 - p)).sum()
            t[k] += np.clip(slope / max(bend, 1e-3), -0.5, 0.5)
    return np.maximum.accumulate(t + np.array([0, 1e-6]))


def grade_of(quality: str, toxic: str):
    """0 low quality, 1 toxic, 2 clean; null where a rating is null."""
    q, t = col(quality), col(toxic)
    return F.when(q.isNull() | t.isNull(), None).when(q <= 0, 0).when(t > 0, 1).otherwise(2)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality: str = "quality",
        toxic: str = "toxic", max_per_grade: int = MAX_PER_GRADE) -> OrdinalModel:
    """The model of a bounded sample of labelled documents (see the module's docstring)."""
    rated = labels.select(col(id_col).cast("long").alias("id"), grade_of(quality, toxic).alias("grade")).where("id is not null and grade is not null")
    share = {r[0]: float(r[1]) for r in rated.groupBy("grade").count().collect()}
    picked = None
    for g in range(GRADES):
        part = rated.where(F.col("grade") == g).orderBy(F.xxhash64("id"), "id").limit(max_per_grade)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(col(id_col).cast("long").alias("doc"), col(text_col).cast("string").alias("text"))

    # the ids are at most GRADES * max_per_grade rows, so the join may broadcast them
    sample = texts.join(F.broadcast(picked), F.col("doc") == F.col("id")).select("grade", "doc", F.coalesce("text", F.lit("")).alias("text"))
    # copies of a text are one observation
    sample = sample.groupBy("grade", F.xxhash64("text").alias("h")).agg(F.min("doc").alias("doc"), F.first("text").alias("text")).select("grade", "doc", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = np.zeros((GRADES, BUCKETS), np.int64), np.zeros(GRADES, np.int64)
        for batch in slices(batches):
            for g, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                held[g, np.unique(features(text))] += 1
                seen[g] += 1
        for g in np.flatnonzero(seen):
            used = np.append(np.flatnonzero(held[g]), BUCKETS)  # the last: how many documents
            n = np.append(held[g][used[:-1]], seen[g])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), g, np.int32)), pa.array(used), pa.array(n)], ["grade", "bucket", "n"])

    # at most GRADES * BUCKETS rows come to the driver, then a few buckets of each document
    table = sample.mapInArrow(counted, "grade int, bucket long, n long").groupBy("grade", "bucket").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros((GRADES, BUCKETS + 1))
    held[table["grade"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    del table
    use = _telling(held[:, :-1], held[:, -1])

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.sort([b for b in features(t) if use[b]]).astype(np.int32) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["grade", "doc", "x"])

    rows = sample.mapInArrow(buckets, "grade int, doc long, x array<int>").toArrow().to_pydict()
    order = sorted(range(len(rows["doc"])), key=lambda i: (rows["doc"][i], rows["grade"][i], rows["x"][i]))  # whatever the order of tasks
    return fit_sample(Sample.of([(rows["grade"][i], rows["x"][i]) for i in order]), share, use)


def _scored(model: OrdinalModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in slices(batches):
            s = np.array([scorer.score(t) for t in batch.column(batch.num_columns - 1).to_pylist()])
            tails = model.tails(s)
            made = [pa.array(s), pa.array(tails.sum(axis=1)), pa.array(tails[:, 0]), pa.array(tails[:, 1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", "score", "expected_grade", "p_grade1", "p_grade2"])

    return score


def rate(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """Per row: doc_id, score, expected_grade, p_grade1 and p_grade2 (tail probabilities), kept."""
    given = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    out = given.mapInArrow(_scored(model), "doc_id long, score double, expected_grade double, p_grade1 double, p_grade2 double")
    return out.withColumn("kept", F.col("p_grade2") >= keep_at)


def keep_good(docs: DataFrame, model: OrdinalModel, text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs``, all columns, whose top-grade tail probability is at least ``keep_at``."""
    at = docs.columns.index(text_col)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # whatever the names are

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in slices(batches):
            tails = model.tails(np.array([scorer.score(t) for t in batch.column(at).to_pylist()]))
            yield batch.filter(pa.array(tails[:, -1] >= keep_at))

    return plain.mapInArrow(passing, plain.schema).toDF(*docs.columns)
