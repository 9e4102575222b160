"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue (operator 13).

A text is cut into pre-tokens by the tokenizer's pattern; each is merged by itself. The bytes of a pre-token
are a linked list of symbols. The queue has a bucket for each merge rank with the list positions
whose pair has that rank, and bitmaps over the buckets in two levels: a bit says that a bucket, or a word of buckets, is not
empty, so that find-first-set on the upper word and then on the lower gives the lowest rank. A bucket gives its
leftmost position first. A merge changes at most two neighbouring pairs, which are queued anew; what was queued for a pair that
has changed since is stale, found by comparing ranks, and skipped. So n bytes take O(n log n) steps at most, however long the
pre-token is.

Ids are those of the tiktoken library for the same rank file and pattern. Its tables of letters and numbers can be older
than those of the ``regex`` module, which cuts here: the characters on which they differ are found once for each worker,
and cut as the library cuts them. A file with a rank for each single byte is expected; ids are the ranks.

The rank file is read by each Python worker from a path that is a parameter. The ids of short pre-tokens are remembered per
worker, over its tasks and up to a bound, which only saves time.

Defined results: null and empty texts have no ids; no ids decode to no bytes; null ids decode to null, an unknown id is an error; rows
repeat as given, extra columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, slices

RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_NONE = -1
_REMEMBER = 64
_MEMO_LIMIT = 450_000
#: A character that both tables count as neither letter, number nor blank.
_OTHER = "§"


def merger(rank: dict[bytes, int]) -> Callable[[bytes], list[int]]:
    """A function from the bytes of a pre-token to its ids, by a queue of positions over the ranks.

    ``words`` have a bit for each bucket, ``top`` a bit for each word; both are about as long as the square root of the number of
    ranks. The queue is empty between calls. Queueing and taking stand in the loop itself, as they are all of its work.
    """
    ranks = max(rank.values()) + 1
    shift = max(1, (ranks - 1).bit_length() + 1 >> 1)
    words, low = [0] * ((ranks - 1 >> shift) + 1), (1 << shift) - 1
    bits = [1 << b for b in range(max(low + 1, len(words)))]
    buckets: dict[int, int | list[int]] = {}  # a position, or a heap of several
    known, longest, add_to, take_from = rank.get, max(map(len, rank)), heapq.heappush, heapq.heappop

    def merge(raw: bytes) -> list[int]:
        n = len(raw)
        if n <= longest and (whole := known(raw)) is not None:
            return [whole]
        if not n:
            return []
        end = list(range(1, n + 1))  # of the symbol at a position, which is where the next one starts
        before = list(range(-1, n))
        pair = [known(raw[i : i + 2], _NONE) for i in range(n)]  # rank of the symbol with the next one
        pair[-1] = _NONE
        top, changed = 0, range(n)
        while True:
            for i in changed:  # into the bucket of its rank
                if (r := pair[i]) == _NONE:
                    continue
                if r not in buckets:
                    buckets[r] = i
                    w = r >> shift
                    words[w] |= bits[r & low]
                    top |= bits[w]
                elif type(held := buckets[r]) is int:
                    buckets[r] = [held, i] if held <= i else [i, held]
                else:
                    add_to(held, i)
            while top:  # the leftmost position of the lowest rank, which may be stale
                w = (top & -top).bit_length() - 1
                word = words[w]
                bit = word & -word
                r = (w << shift) + bit.bit_length() - 1
                i = buckets[r]
                if type(i) is not int:
                    several, i = i, take_from(i)
                    if several:
                        if pair[i] == r:
                            break
                        continue
                del buckets[r]
                words[w] = word ^ bit
                if word == bit:
                    top ^= bits[w]
                if pair[i] == r:
                    break
            else:
                break
            j = end[i]
            k = end[i] = end[j]
            before[k] = i
            pair[j] = _NONE
            # no token is longer than the longest, so that these slices stay short
            pair[i] = known(raw[i : end[k]], _NONE) if k < n and end[k] - i <= longest else _NONE
            if (h := before[i]) >= 0:
                pair[h] = known(raw[h:k], _NONE) if k - h <= longest else _NONE
                changed = (i, h)
            else:
                changed = (i,)
        out, i = [], 0
        while i < n:
            out.append(rank[raw[i : end[i]]])
            i = end[i]
        return out

    return merge


class ByteBpe:
    """Ranks and pattern of a tokenizer; encodes and decodes single texts."""

    def __init__(self, path: str = RANKS, pattern: str = PATTERN):
        import regex

        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError(f"{path}: not every byte has a rank")
        self.surface = {i: token for token, i in self.rank.items()}
        self.merge = merger(self.rank)
        self.table = pa.array([self.surface.get(i) for i in range(max(self.surface) + 1)], pa.large_binary())  # by id
        compiled = regex.compile(pattern)
        self.findall, self.finditer = compiled.findall, compiled.finditer
        self.odd = frozenset(_cut_otherwise(pattern))
        self.stand_in = {ord(c): _OTHER for c in self.odd}
        self.memo = _Memo(self)

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens; they are the whole text."""
        if not text.isascii() and not self.odd.isdisjoint(text):
            return [text[m.start() : m.end()] for m in self.finditer(text.translate(self.stand_in))]
        return self.findall(text)

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids of a text as native 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.pieces(text))) if text else b""

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.surface.__getitem__, ids))

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids, for all lists at once: side by side, tokens of one list are its bytes already."""
        if lists.null_count:
            lists = pc.fill_null(lists, pa.scalar([], lists.type))
        tokens = pc.take(self.table, lists.flatten())
        if tokens.null_count:
            raise ValueError("an id without a token")
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        at = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset :][starts]
        return pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(np.ascontiguousarray(at)), tokens.buffers()[2]])


class _Memo(dict):
    """pre-token -> ids, for short ones, in two generations: what is asked for again outlives the change to the next one."""

    def __init__(self, model: ByteBpe):
        super().__init__()
        self.model = model
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(self.model.merge(piece.encode()), np.int32).tobytes()
        if len(piece) <= _REMEMBER:
            if len(self) >= _MEMO_LIMIT:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def _cut_otherwise(pattern: str) -> list[str]:
    """Letters and numbers of the ``regex`` module that the tiktoken library counts as neither.

    Only characters newer than Python's own tables are tried: each behind "!", with ranks by which the two are one
    token if the library puts them in one pre-token.
    """
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    new = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    ranks = {bytes([b]): b for b in range(256)}
    for c in new:
        raw = ("!" + c).encode()
        for k in range(2, len(raw) + 1):
            ranks.setdefault(raw[:k], len(ranks))
    library = tiktoken.Encoding("characters", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return [c for c in new if len(library.encode_ordinary("!" + c)) == 1]


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def loaded(path: str, pattern: str) -> ByteBpe:
    """The tokenizer of this Python worker, kept for its next tasks."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(path, pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Per row: doc_id, ids."""
    given = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in slices(batches, 500):
            model = model or loaded(ranks, pattern)
            parts = [model.encode_bytes(t) for t in batch.column(1).to_pylist()]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]), pa.int32())
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(parts), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return given.mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Per row: doc_id, ids, raw (the bytes that the ids stand for)."""
    given = encoded.select(col(id_col).cast("long").alias("doc_id"), col(ids_col).cast("array<int>").alias("ids"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in slices(batches, 500):
            model = model or loaded(ranks, pattern)
            raw = pc.if_else(batch.column(1).is_null(), None, model.decode_lists(batch.column(1))).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], ["doc_id", "ids", "raw"])

    return given.mapInArrow(decoded, "doc_id long, ids array<int>, raw binary")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded bytes."""
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                          F.sha2("raw", 256).alias("decoded_sha256"))
