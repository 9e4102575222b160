"""Vector code compression: product codes by k-means over anchors-hierarchy trees (operator 11).

Each component becomes the integer floor(4096 * x); a vector is cut into ``PARTS`` equal consecutive parts,
and each part position has a codebook of up to ``ENTRIES`` entries. Vectors are held in shards of bounded
size; a shard has a metric tree for each part position (``anchors_tree``), whose balls cache sums and counts. The
trees are built once and kept as a table. A round walks them with the codebooks of that round: entries that can
be nearest nowhere in a ball leave its list, and a ball with one entry left gives its cached sums as a whole.
What a task finds is summed by Spark by part, entry and place; only the codebooks (entries x width numbers, whatever
the number of vectors) pass through the driver. All arithmetic that decides is in integers.

The codebooks start as the parts of the ``ENTRIES`` smallest ids, ascending. Defined results: a vector that is
null, or holds a null, NaN or infinite component, has no row. An id that repeats starts one entry, with the least
of its vectors (componentwise order), and each of its rows has a result row; null ids count as one id, after all
others. With fewer ids the codebooks have fewer entries. Ties go to the lower entry; unused entries stay. Null labels
are equal labels. An empty table gives an empty result. Extra columns are ignored. Vectors of different lengths, or of
a length that ``PARTS`` does not divide, are an error, and so are components too large for exact 64-bit distances.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors_tree import Forest
from .common import Scratch, col

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Components in a shard at most: a shard and its trees take a few MB.
SHARD = 131_072


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _first_ids(ids: list, points: np.ndarray, entries: int) -> list[dict]:
    """The smallest ids of a shard (nulls last), each with the least of its vectors."""
    distinct = sorted({i for i in ids if i is not None})[:entries]
    wanted = dict.fromkeys([*distinct, None][:entries])
    for i, row in zip(ids, points, strict=True):
        if i in wanted and (wanted[i] is None or row.tolist() < wanted[i]):
            wanted[i] = row.tolist()
    return [{"vec_id": i, "x": x} for i, x in wanted.items() if x is not None]


def _parts(points: np.ndarray, parts: int) -> np.ndarray:
    return np.ascontiguousarray(points.reshape(len(points), parts, points.shape[1] // parts).transpose(1, 0, 2))


def _check(points: np.ndarray, parts: int) -> None:
    width = points.shape[1]
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    if points.size and np.abs(points).max() > (2.0**62 / width) ** 0.5 / 2:
        raise ValueError("components are too large for exact distances in 64 bits")


def _shards(rows: DataFrame, parts: int, entries: int, shard: int) -> DataFrame:
    """The vectors in shards, with their trees; ``rows``: vec_id, label, x."""
    label = rows.schema["label"].dataType
    schema = T.StructType([
        T.StructField("vec_id", T.ArrayType(T.LongType())), T.StructField("label", T.ArrayType(label)), T.StructField("width", T.IntegerType()),
        T.StructField("points", T.BinaryType()), T.StructField("trees", T.BinaryType()),
        T.StructField("first", T.ArrayType(T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("x", T.ArrayType(T.LongType()))])))])
    first = pa.list_(pa.struct([("vec_id", pa.int64()), ("x", pa.list_(pa.int64()))]))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = batch.column(2)
        widths = np.diff(vectors.offsets.to_numpy())
        if widths.min() != widths.max():
            raise ValueError("vectors of different lengths")
        points = vectors.flatten().to_numpy().reshape(len(widths), widths[0])
        _check(points, parts)
        trees = Forest.over(_parts(points, parts)).dump()
        whole = pa.array([0, batch.num_rows], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(whole, batch.column(0)), pa.ListArray.from_arrays(whole, batch.column(1)), pa.array([int(widths[0])], pa.int32()),
             pa.array([points.astype(np.int32).tobytes()], pa.binary()), pa.array([trees], pa.binary()),
             pa.array([_first_ids(batch.column(0).to_pylist(), points, entries)], first)], schema.names)

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, most = 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                most = most or max(64, shard // max(1, len(batch.column(2)[at])))
                piece = batch.slice(at, most - n)
                held.append(piece)
                at, n = at + piece.num_rows, n + piece.num_rows
                if n == most:
                    yield one(pa.concat_batches(held))
                    held, n = [], 0
        if held:
            yield one(pa.concat_batches(held))

    return rows.mapInArrow(built, schema)


def _read(batch: pa.RecordBatch, row: int, parts: int) -> tuple[np.ndarray, Forest]:
    width = batch.column("width")[row].as_py()
    points = np.frombuffer(batch.column("points")[row].as_buffer(), np.int32).reshape(-1, width)
    return _parts(points, parts), Forest.load(batch.column("trees")[row].as_py())


def _round(shards: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round of assigning all parts and replacing entries by floored means."""
    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                parts, forest = _read(batch, row, len(books))
                walk = forest.walk(parts, books)
                sums, counts = sums + walk.sums, counts + walk.counts
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
                                          pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    found = shards.select("width", "points", "trees").mapInArrow(gathered, "part int, entry int, n long, sums array<long>")
    total = (found.select("part", "entry", "n", F.posexplode("sums").alias("place", "value")).groupBy("part", "entry", "place")
                  .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.sum("n").alias("n")))
    out = books.copy()
    for r in total.collect():  # at most entries x width rows
        out[r["part"], r["entry"], r["place"]] = int(r["value"]) // r["n"]
    return out


def _coded(shards: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every vector under the final codebooks."""
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", shards.schema["label"].dataType.elementType),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                parts, forest = _read(batch, row, len(books))
                entry = forest.walk(parts, books).entry
                gap = parts - books[np.arange(len(books))[:, None], entry]
                code = [bytes(c).hex() for c in entry.T.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id")[row].values, batch.column("label")[row].values, pa.array(code, pa.string()),
                                                  pa.array(np.einsum("pvd,pvd->v", gap, gap), pa.int64())], schema.names)

    return shards.select("vec_id", "label", "width", "points", "trees").mapInArrow(coded, schema)


class Codes:
    """Codebooks (by part, entry, place), and a table with the code of every vector."""

    def __init__(self, books: np.ndarray, rows: DataFrame, scratch: Scratch):
        self.books, self.rows, self.scratch = books, rows, scratch

    def drop(self) -> None:
        """Delete the stored rows, when nothing reads them any more."""
        self.scratch.drop("")

    def decode(self, code_col: str = "code") -> Column:
        """The vector that a code stands for, as integers, in the scale of the codebooks."""
        books = F.array(*(F.array(*(F.array(*map(F.lit, entry)) for entry in part)) for part in self.books.tolist()))
        each = F.transform(books, lambda part, p: part[F.conv(F.substring(col(code_col), p * 2 + 1, F.lit(2)), 16, 10).cast("int")])
        return F.flatten(each)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, shard: int = SHARD) -> Codes:
    """Fit the codebooks on all vectors and code each of them; rows: vec_id, label, code, error."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index has two hex digits")
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vector-codes")
    given = vectors.select(col(id_col).cast("long").alias("vec_id"), col(label_col).alias("label"), col(vector_col).cast("array<double>").alias("x"))
    kept = given.filter(usable(F.col("x"))).withColumn("x", F.transform("x", lambda x: F.floor(x * SCALE).cast("long")))
    shards = scratch.stage(_shards(kept, parts, entries, shard), "shards")
    widths = shards.agg(F.min("width"), F.max("width")).first()
    if widths[0] != widths[1]:
        raise ValueError("vectors of different lengths")
    first = (shards.select(F.inline("first")).groupBy("vec_id").agg(F.min("x").alias("x"))
                   .orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect())
    books = _parts(np.array([r["x"] for r in first], np.int64).reshape(len(first), widths[0] or 0), parts)
    if first:
        for _ in range(rounds):
            books = _round(shards, books)
    rows = scratch.stage(_coded(shards, books), "coded")
    scratch.drop("shards")
    return Codes(books, rows, scratch)


def code_table(vectors: DataFrame, **names) -> DataFrame:
    """vec_id, code, error, label_error (errors summed over equal labels), codebooks_sha256 of every vector."""
    codes = compress(vectors, **names)
    totals = codes.scratch.stage(codes.rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_of"), "labels")
    digest = hashlib.sha256(",".join(map(str, codes.books.reshape(-1).tolist())).encode()).hexdigest()
    # Spark broadcasts the totals where their stored size is small, and splits a hot label where it is not
    return (codes.rows.join(totals, F.col("label").eqNullSafe(F.col("_of")), "left")
                 .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
