"""Exact removal of repeated 100-byte strings by shard suffix arrays (operator 10).

A byte goes if a 100-byte string that covers it also starts earlier (in a smaller doc_id, or earlier in
the same document). Texts are taken whole, as UTF-8.

1. Every window of 100 bytes owns an anchor (see ``anchors``); neighbouring windows with one anchor
   form a span. Spans whose anchor occurs once in the corpus are done: equal windows have equal anchors.
   Occurrences are counted with a partial aggregate, then joined back, so a frequent line is no group.
2. Equal spans (64-bit digest next to the 64-bit anchor and the offsets) form a class; every member but
   the first repeats an earlier one and is removed whole. Only the first goes on, so what follows does
   not grow with the number of copies.
3. Anchors with several classes are where texts agree in part. The spans of their classes' first members
   are dealt to shards by anchor. A shard sorts its suffixes by induced sorting (``sais``), computes
   permuted common prefixes, and suffixes that share 100 bytes with their neighbour form groups; all but
   the earliest of a group are repeats. An anchor with over ``HOT`` classes would be an unbounded shard:
   its windows are compared by 128-bit digest in a partial aggregate instead.
4. Runs of repeated windows are joined to their documents and the bytes under them are cut.

Intermediate tables are written to the shared folder, and shuffle files are released after each.

Defined results: a null text is empty (0 bytes, the digest of nothing). A null doc_id is neither removed
from nor a source. Equal rows with one doc_id are one document, each row is returned; a doc_id must not
have two different texts. Texts under 100 bytes stay as they are. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import LENGTH, spans
from .common import Scratch, col, slices
from .sais import permuted_lcp, suffix_array

SHARD_BYTES = 3_500_000
HOT = 20_000
_REACH = LENGTH - 1


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _span_rows(with_digest: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, parts, digests = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = _utf8(text)
                found = spans(data)
                if not len(found[0]):
                    continue
                ids.append(np.full(len(found[0]), doc_id, np.int64))
                parts.append(found)
                if with_digest:
                    digests.append(np.fromiter(
                        (xxhash.xxh3_64_intdigest(data[s : s + c + _REACH]) for s, c in zip(found[1].tolist(), found[2].tolist(), strict=True)),
                        np.uint64, len(found[0])).view(np.int64))
            if not parts:
                continue
            anchor, start, count, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
            if with_digest:
                columns = [anchor, np.concatenate(ids), start, (count << 8 | offset).astype(np.int32), np.concatenate(digests)]
                names = ["anchor", "doc", "start", "shape", "digest"]
            else:
                anchor, n = np.unique(anchor, return_counts=True)
                columns, names = [anchor, n], ["anchor", "n"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return rows


def _cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the spans wanted of them -> the bytes of each span."""
    for batch in slices(batches):
        anchor, doc, start, shape, data = [], [], [], [], []
        for doc_id, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            raw = _utf8(text)
            for w in wanted:
                anchor.append(w["anchor"])
                doc.append(doc_id)
                start.append(w["start"])
                shape.append(w["shape"])
                data.append(raw[w["start"] : w["start"] + (w["shape"] >> 8) + _REACH])
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int64()), pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(shape, pa.int32()), pa.array(data, pa.binary())],
            ["anchor", "doc", "start", "shape", "data"])


def repeated_windows(data: list[bytes], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first window start, number of windows) of the windows of a shard that occur earlier in it."""
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.ones(int(begin[-1]) + 1, np.uint8)  # 1 ends a span, 0 the shard; UTF-8 has no byte over 244
    text[-1] = 0
    joined = np.frombuffer(b"".join(data), np.uint8)
    place = np.arange(len(joined)) + np.repeat(np.arange(len(data)), sizes)
    text[place] = joined + np.uint8(2)
    array = suffix_array(text, 248)
    common = permuted_lcp(text, array, begin[:-1], 2 * LENGTH + 80)
    span = np.repeat(np.arange(len(data)), sizes + 1)
    ends = np.append(begin[1:][span] - 1, len(text) - 1)  # where the span of a position ends
    common = np.minimum(common, ends - np.arange(len(text)))
    fresh = common[array] < LENGTH
    fresh[0] = True
    group = np.cumsum(fresh) - 1
    size = np.bincount(group)
    member = np.flatnonzero(size[group] > 1)
    at = array[member].astype(np.int64)
    group, own = group[member], span[at]
    first = start[own] + at - begin[own]
    order = np.lexsort((first, doc[own], group))
    group, own, first = group[order], own[order], first[order]
    later = np.zeros(len(group), bool)
    later[1:] = group[1:] == group[:-1]
    own, first = own[later], first[later]
    order = np.lexsort((first, own))
    own, first = own[order], first[order]
    edge = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (first[1:] != first[:-1] + 1)])) if len(own) else own
    return doc[own[edge]], first[edge], np.diff(np.append(edge, len(own)))


def _shard(table: pa.Table) -> pa.Table:
    found = repeated_windows(table["data"].to_pylist(), table["doc"].to_numpy(), table["start"].to_numpy())
    return pa.table([pa.array(np.asarray(x, np.int64)) for x in found], names=["doc", "start", "count"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of the spans by a 128-bit digest."""
    for batch in slices(batches):
        docs, starts, digests = [], [], []
        for doc, start, shape, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            for i in range(shape >> 8):
                docs.append(doc)
                starts.append(start + i)
                digests.append(xxhash.xxh3_128_digest(data[i : i + LENGTH]))
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(digests, pa.binary())], ["doc", "start", "window"])


def cut(data: bytes, runs: list[dict] | None) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs) for runs of repeated window starts."""
    if not runs:
        return data, 0, 0
    found = np.array([(r["start"], r["start"] + r["count"] + _REACH) for r in runs])
    found = found[np.argsort(found[:, 0], kind="stable")]
    reach = np.maximum.accumulate(found[:, 1])
    fresh = np.concatenate([[True], found[1:, 0] > reach[:-1]])
    begin, end = found[fresh, 0], np.minimum(reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(reach) - 1)], len(data))
    left, at = [], 0
    for b, e in zip(begin.tolist(), end.tolist(), strict=True):
        left.append(data[at:b])
        at = e
    left.append(data[at:])
    return b"".join(left), int((end - begin).sum()), len(begin)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        size, removed, edges, sha = [], [], [], []
        for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            data = _utf8(text)
            left, n, k = cut(data, runs)
            size.append(len(data))
            removed.append(n)
            edges.append(k)
            sha.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(edges, pa.int64()), pa.array(sha, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_runs(given: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, start, count) of runs of repeated windows, for documents (doc_id, text) with non-null ids."""
    counted = given.mapInArrow(_span_rows(False), "anchor long, n long")
    shared = scratch.stage(counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "shared")
    rows = given.mapInArrow(_span_rows(True), "anchor long, doc long, start long, shape int, digest long")
    spread = scratch.stage(rows.join(shared, "anchor", "left_semi"), "spans")
    key = ["anchor", "shape", "digest"]
    classes = scratch.stage(spread.groupBy(*key).agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("members")), "classes")
    copies = spread.join(classes.where("members > 1").drop("members"), key).where("struct(doc, start) <> first")
    copies = scratch.stage(copies.select("doc", "start", F.shiftright("shape", 8).cast("long").alias("count")), "copies")
    several = classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1")
    wanted = classes.join(several, "anchor").select("anchor", "shape", "first.*", "classes")
    wanted = scratch.stage(wanted, "wanted")
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "start", "shape")).alias("wanted"))
    cut_out = given.join(per_doc, given.doc_id == F.col("doc")).select("doc_id", "text", "wanted").mapInArrow(
        _cut_spans, "anchor long, doc long, start long, shape int, data binary")
    pieces = scratch.stage(cut_out, "pieces")
    hot = scratch.stage(wanted.groupBy("anchor").agg(F.first("classes").alias("n")).where(F.col("n") > HOT).select("anchor"), "hot")
    scratch.drop("spans", "shared", "classes")
    usual = pieces.join(hot, "anchor", "left_anti")
    shards = 1 + (usual.agg(F.sum(F.octet_length("data"))).first()[0] or 0) // SHARD_BYTES
    usual = usual.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "doc", "start", "data")
    sorted_runs = usual.groupBy("shard").applyInArrow(_shard, "doc long, start long, count long")
    windows = pieces.join(hot, "anchor", "left_semi").select("doc", "start", "shape", "data").mapInArrow(_windows, "doc long, start long, window binary")
    earliest = windows.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("first"))
    hot_runs = windows.join(earliest, "window").where("struct(doc, start) <> first").select("doc", "start", F.lit(1).cast("long").alias("count"))
    return copies.unionByName(scratch.stage(sorted_runs.unionByName(hot_runs), "sorted"))


def _with_runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    given = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    runs = repeated_runs(given.where("doc_id is not null"), scratch)
    runs = runs.groupBy("doc").agg(F.collect_set(F.struct("start", "count")).alias("runs"))
    return given.join(runs, given.doc_id == F.col("doc"), "left").select("doc_id", "text", "runs")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (see the module's docstring)."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _with_runs(docs, id_col, text_col).mapInArrow(_finish, schema)


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        left = [cut(_utf8(t), r)[0] for t, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(left, pa.binary())], ["doc_id", "kept"])


def kept_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and the bytes that stay (binary: a cut may fall inside a character)."""
    return _with_runs(docs, id_col, text_col).mapInArrow(_left, "doc_id long, kept binary")
