"""Edit-aware token counts over segment trees of pre-tokens (operator 5).

A text is cut into pre-tokens by the tokenizer's pattern; runs of ``LEAF`` of them are the leaves of a
segment tree that holds, for each subtree, its characters and its tokens. An edit (position, length,
replacement) finds its leaves by descending on characters. Only the leaves it touches are cut and counted
again, with one leaf before them as boundary context, and onwards to the first old leaf boundary at which
the new cut also ends: the pattern looks at most one pre-token beyond a match and never behind, so from
there on nothing changes. Each leaf holds its own part of the text, so that a region costs what its leaves cost, however
long the text is. The region's leaves get the new counts and the sums above them are updated, in
O(log n) each. Edits of one batch whose regions meet are applied as one region. Where the replacements are over four times as long
as the text, they are a new text, and it is counted as one. Counts are exactly those of encoding the edited text anew.

The tokenizer is byte-level BPE from a rank file; its path and pattern are parameters. The number of
tokens of a pre-token is remembered per Python worker, which only saves time.

Defined results: a null or empty text has 0 tokens; edits lie within the text, do not overlap, and are
given in positions of the text before any of them; a null list of edits is an empty one; rows repeat as
given; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, free_name, slices

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 32
_MEMO_LIMIT = 500_000

Edit = tuple[int, int, str]


class Counter:
    """Pre-tokens of a text and the number of tokens of each."""

    def __init__(self, path: str = RANKS, pattern: str = PATTERN):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        compiled = regex.compile(pattern)
        self.cut, self.match = compiled.findall, compiled.match
        self.memo = _Memo(self.encoding)

    def counts(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))


class _Memo(dict):
    def __init__(self, encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, piece: str) -> int:
        if len(self) > _MEMO_LIMIT:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n


class SegmentTree:
    """Sums of characters and tokens over leaves; the shape is that of a full binary tree."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.size = 1 << max(0, (max(1, len(chars)) - 1).bit_length())
        pad = [0] * (self.size - len(chars))
        self.chars = [0] * self.size + chars + pad
        self.tokens = [0] * self.size + tokens + pad
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, position: int) -> tuple[int, int]:
        """(leaf, its start) of the leaf that holds a character position (the last leaf beyond the end)."""
        i, before = 1, 0
        while i < self.size:
            i *= 2
            if position >= before + self.chars[i]:
                before += self.chars[i]
                i += 1
        return i - self.size, before

    def update(self, leaf: int, chars: int, tokens: int) -> None:
        i = leaf + self.size
        dc, dt = chars - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += dc
            self.tokens[i] += dt
            i //= 2


class CountedText:
    """A text with its tree; ``apply`` keeps the counts right under edits. Each leaf holds its own part of the text."""

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        pieces = counter.cut(text)
        self.pretokens = len(pieces)
        self.recounted = 0  # pre-tokens cut and counted again by edits
        self.leaves = -(-len(pieces) // LEAF)
        starts = np.arange(0, len(pieces), LEAF)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        sums = lambda x: np.add.reduceat(x, starts).tolist() if len(x) else []
        chars = sums(sizes)
        ends = np.cumsum(chars).tolist()
        self.parts = [text[e - n : e] for n, e in zip(chars, ends, strict=True)]
        self.tree = SegmentTree(chars, sums(counter.counts(pieces)))

    @property
    def text(self) -> str:
        return "".join(self.parts)

    @property
    def tokens(self) -> int:
        return self.tree.tokens[1]

    def apply(self, edits: list[Edit]) -> None:
        """Apply edits (position, length, replacement), all in positions of the present text."""
        edits = sorted(edits)
        if not edits:
            return
        if not self.leaves or sum(len(new) for *_, new in edits) > 4 * max(256, self.tree.chars[1]):
            self._rebuild(self._edited(self.text, edits, 0))  # a new text rather than an edit
            return
        tree, regions = self.tree, []
        for edit in edits:  # regions by leaves, one before the edit included; those that meet become one
            first = max(0, min(tree.find(edit[0])[0], self.leaves - 1) - 1)
            last = min(tree.find(edit[0] + edit[1])[0], self.leaves - 1)
            if regions and first <= regions[-1][1] + 1:
                regions[-1][1] = max(regions[-1][1], last)
                regions[-1][2].append(edit)
            else:
                regions.append([first, last, [edit]])
        for first, _, own in reversed(regions):  # from the right, so that positions to the left stay
            self._region(first, own)

    def _region(self, first: int, edits: list[Edit]) -> None:
        """Cut the leaves of some edits anew, from ``first`` on; only these and a few behind them are looked at."""
        tree, parts, leaves, match = self.tree, self.parts, self.leaves, self.counter.match
        start = self._start(first)
        while not parts[first] and first:  # emptied leaves are no context
            first -= 1
            start = self._start(first)
        done = edits[-1][0] + edits[-1][1] - start  # the end of the last edit, in the old text from the region's start
        stop, old = first, 0
        while stop < leaves and (old < done or stop == first):
            old += len(parts[stop])
            stop += 1
        found = self._edited("".join(parts[first:stop]), [(at - start, n, new) for at, n, new in edits], 0)
        # where the leaf before each of these positions ends: there the old cut may go on
        bounds = {len(found): stop} if old > done else {}
        at, known, step, pieces = 0, stop, 1, []
        while True:
            m = match(found, at) if at < len(found) else None
            if (m is None or m.end() == len(found)) and known < leaves:  # it may depend on what follows
                more, length = [], len(found)
                for part in parts[known : known + step]:
                    more.append(part)
                    known += 1
                    length += len(part)
                    bounds.setdefault(length, known)
                found, step = found + "".join(more), 2 * step
                continue
            if m is None:
                stop = leaves
                break
            pieces.append(m[0])
            at = m.end()
            if at in bounds:
                stop = bounds[at]
                break
        self._fill(first, max(stop, first + 1), pieces)

    def _start(self, leaf: int) -> int:
        """Characters before a leaf: sums of the subtrees to its left."""
        i, before = leaf + self.tree.size, 0
        while i > 1:
            if i & 1:
                before += self.tree.chars[i - 1]
            i //= 2
        return before

    def _fill(self, first: int, stop: int, pieces: list[str]) -> None:
        """Spread new pre-tokens over the leaves of a region and update the sums above."""
        self.recounted += len(pieces)
        room = stop - first
        per = -(-len(pieces) // room)
        sizes, counts = [len(p) for p in pieces], self.counter.counts(pieces).tolist()
        if per > 4 * LEAF:  # the region has outgrown its leaves: a new tree, nothing else is counted again
            tree = self.tree
            at = tree.size
            self.parts[first:stop] = ["".join(pieces[i : i + LEAF]) for i in range(0, len(pieces), LEAF)]
            chars = tree.chars[at : at + first] + [sum(sizes[i : i + LEAF]) for i in range(0, len(sizes), LEAF)] + tree.chars[at + stop : at + self.leaves]
            tokens = tree.tokens[at : at + first] + [sum(counts[i : i + LEAF]) for i in range(0, len(counts), LEAF)] + tree.tokens[at + stop : at + self.leaves]
            self.leaves, self.tree = len(chars), SegmentTree(chars, tokens)
            return
        for k in range(room):
            self.parts[first + k] = "".join(pieces[k * per : (k + 1) * per])
            self.tree.update(first + k, sum(islice(sizes, k * per, (k + 1) * per)), sum(islice(counts, k * per, (k + 1) * per)))

    def _rebuild(self, text: str) -> None:
        recounted = self.recounted
        self.__init__(text, self.counter)
        self.recounted = recounted + self.pretokens

    @staticmethod
    def _edited(text: str, edits: list[Edit], shift: int) -> str:
        out, at = [], 0
        for position, n, new in edits:
            out += [text[at : position + shift], new]
            at = position + shift + n
        out.append(text[at:])
        return "".join(out)


# Edits of a cleaning pass: marks repeated behind words, addresses, long secrets; and lines said before.
_CLEAN = re.compile(r"(?<=\w)([#*$%&!])\1+(?=\s|$)|(?<![\w.+-])[\w.+-]{1,64}@[\w-]{1,63}(?:\.[\w-]{1,63}){1,8}|(?<!\w)[0-9a-fA-F]{32,64}(?!\w)")


_HINT = re.compile(r"[#*$%&!]{2}|[0-9@]")  # most lines have none of these


def cleaning_edits(text: str) -> list[Edit]:
    """Edits that a cleaning pass makes: repeated lines go, marks behind words go, addresses and secrets get a tag."""
    edits: list[Edit] = []
    seen: set[str] = set()
    at = 0
    for line in text.split("\n"):
        n = len(line)
        if line.strip() and line in seen:
            edits.append((at, n, ""))
        else:
            seen.add(line)
            for m in _CLEAN.finditer(line) if _HINT.search(line) else ():
                new = "" if m[1] else "[address]" if "@" in m[0] else "[secret]"
                edits.append((at + m.start(), m.end() - m.start(), new))
        at += n + 1
    return edits


_LOADED: dict[tuple, Counter] = {}


def loaded(path: str, pattern: str) -> Counter:
    """The counter of this Python worker, kept for its next tasks."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Counter(path, pattern)
    return _LOADED[path, pattern]


def edited_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits_col: str | None = None,
                  path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Per row: doc_id, n_tokens, n_edits, n_pretokens, n_recounted, n_tokens_after.

    ``edits_col``: array of struct(position, length, replacement); without it the edits of ``cleaning_edits``.
    """
    given = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"),
                        *([col(edits_col).alias("edits")] if edits_col else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in slices(batches):
            counter = counter or loaded(path, pattern)
            rows = []
            given_edits = batch.column(2).to_pylist() if edits_col else [None] * batch.num_rows
            for text, listed in zip(batch.column(1).to_pylist(), given_edits, strict=True):
                tree = CountedText(text or "", counter)
                before = tree.tokens
                edits = [tuple(e.values()) for e in listed or []] if edits_col else cleaning_edits(text or "")
                tree.apply(edits)
                rows.append((before, len(edits), tree.pretokens, tree.recounted, tree.tokens))
            numbers = np.array(rows, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(numbers[:, k]) for k in range(5))],
                                             ["doc_id", "n_tokens", "n_edits", "n_pretokens", "n_recounted", "n_tokens_after"])
        if counter:
            counter.memo.clear()  # an idle worker keeps the ranks only

    return given.mapInArrow(run, "doc_id long, n_tokens long, n_edits long, n_pretokens long, n_recounted long, n_tokens_after long")


def with_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id", into: str = "edits") -> DataFrame:
    """``docs`` with a table of edits (doc_id, position, length, replacement) as one array for each document."""
    own = free_name(docs, "_edit_doc")
    listed = edits.where(col(id_col).isNotNull()).groupBy(col(id_col).alias(own)).agg(
        F.sort_array(F.collect_list(F.struct(F.col("position").cast("long"), F.col("length").cast("long"), F.col("replacement").cast("string")))).alias(into))
    return docs.join(listed, col(id_col) == F.col(own), "left").drop(own)
