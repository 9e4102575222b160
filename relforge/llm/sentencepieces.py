"""SentencePiece encoding and decoding by a streaming Viterbi search (operator 3).

The pieces over a text form a lattice whose nodes are the boundaries between characters. The search
goes through the boundaries from left to right and keeps one surviving backpointer for each; an edge is
at most the longest piece long, so only that many boundaries beyond the current one are alive. Whenever
the survivors of all live boundaries pass one common boundary, the ids up to it can no longer change:
they are committed and the lattice behind it is dropped. The window stays within a few piece lengths,
however long the text is.

Which edge survives depends on the kind of model:

- unigram: the path with the largest sum of piece scores;
- BPE: the path that merging by score would give. Merging a text leaves exactly those paths in which
  each piece, and each two neighbouring pieces, are what merging makes of their own characters; so an
  edge survives if its piece is compatible with the piece before it, and each boundary has one such
  path. Blanks in a row, whose pieces all have one score, the least of all, are merged by themselves, after what follows
  them has been searched with the last blank (which stands alone again if it found no piece).

No piece crosses from another character to a blank, so all paths meet there and each blank starts a new
segment; segments up to 64 characters are remembered, which only saves time. Characters without a piece
become bytes. Ids equal those of the sentencepiece library for the same model file.

The model file is read by each Python worker from a path that is a parameter; nothing is copied.

Defined results: null and empty text have no ids; rows repeat as given; extra columns are carried or
ignored. Decoding returns the text itself, apart from U+2581, which stands for a blank.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
_REMEMBER = 64
_MEMO_LIMIT = 500_000
_PAIR_LIMIT = 500_000
_CHECK_EVERY = 32


class PieceModel:
    """Pieces, scores and kind of a SentencePiece model file; encodes and decodes single texts."""

    def __init__(self, path: str = MODEL, unigram: bool | None = None):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.unk = sp.unk_id()
        self.byte_ids = [-1] * 256
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.surface = [b""] * size
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.surface[i] = bytes([int(piece[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.id_of[piece], self.score[piece] = i, sp.get_score(i)
                self.surface[i] = piece.replace(BLANK, " ").encode()
        self.piece = {i: p for p, i in self.id_of.items()}
        self.longest = max(map(len, self.id_of))
        # a BPE model's merged pieces are scored -1, -2, ... by their rank, a unigram model's by log probability
        ranks = sorted((s for p, s in self.score.items() if len(p) > 1), reverse=True)[:1000]
        self.unigram = not all(s == int(s) for s in ranks) if unigram is None else unigram
        self.unknown_score = min(self.score.values()) - 10.0
        joined = {c for p in self.id_of if len(p) > 1 for c in p}
        inner_blank = any(BLANK in p.lstrip(BLANK) for p in self.id_of)
        cut = "" if "\n" in joined else "\n"
        # a segment: blanks and what follows; line ends stand alone where no piece holds one
        self.segments = None if inner_blank else re.compile(f"{BLANK}*[^{BLANK}{cut}]+|{BLANK}+" + ("|\n" if cut else "")).findall
        self.trie: dict = {}
        for p, i in self.id_of.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = i
        self.compatible: dict[int, bool] = {}
        # the pieces that merging makes of their own characters
        self.stable = set() if self.unigram else {i for p, i in self.id_of.items() if self.merged(p) == [p]}
        # blanks merge after all else, and with nothing but blanks
        blanks = {p for p in self.score if len(p) > 1 and not p.strip(BLANK)}
        mixed = any(p.startswith(BLANK + BLANK) and p not in blanks for p in self.score)
        self.blanks_last = not mixed and max((self.score[p] for p in blanks), default=-1e30) < min(s for p, s in self.score.items() if len(p) > 1 and p not in blanks)
        self.memo = _Memo(self)

    # --- merging, for single pieces and pairs of pieces, and for runs of blanks

    def merged(self, text: str) -> list[str]:
        """The symbols that merging by score leaves of a text (ties: leftmost first)."""
        symbols: list[str | None] = list(text)
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(symbols) and (s := self.score.get(both := symbols[i] + symbols[j])) is not None:
                heapq.heappush(heap, (-s, i, both))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            if symbols[i] is None or (j := after[i]) >= len(symbols) or symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j] = both, None
            after[i] = after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
                offer(i, after[i])
            offer(before[i], i)
        return [s for s in symbols if s is not None]

    def _pair_stays(self, left: int, right: int) -> bool:
        """Whether merging leaves these two pieces, side by side, as they are."""
        known = self.compatible.get(key := left * 1_048_576 + right)
        if known is None:
            if len(self.compatible) > _PAIR_LIMIT:
                self.compatible.clear()
            pieces = [self.piece[left], self.piece[right]]
            known = self.compatible[key] = self.merged("".join(pieces)) == pieces
        return known

    # --- the search

    def _char_ids(self, c: str) -> list[int]:
        """Ids of a character that is no piece."""
        raw = c.encode("utf-8", "surrogatepass")
        return [self.byte_ids[b] for b in raw] if min(self.byte_ids) >= 0 else [self.unk]

    def search(self, text: str, committed: list[int], trace: list | None = None) -> None:
        """Append the ids of a text to ``committed``, as soon as they are settled."""
        unigram, trie, n = self.unigram, self.trie, len(text)
        # survivors by boundary: (start of the last piece, its id or -1 for a character without one, score)
        back: dict[int, tuple[int, int, float]] = {0: (-1, -2, 0.0)}
        base = 0
        for j in range(n):
            here = back.get(j)
            if here is None:
                continue
            _, last, total = here
            node, k = trie, j
            alone = False
            while k < n:
                node = node.get(text[k])
                if node is None:
                    break
                k += 1
                i = node.get("")
                if i is None:
                    continue
                alone = alone or k == j + 1
                if unigram:
                    s = total + self.score[self.piece[i]]
                    if k not in back or s > back[k][2]:
                        back[k] = (j, i, s)
                elif k not in back and i in self.stable and (last < 0 or self._pair_stays(last, i)):
                    back[k] = (j, i, 0.0)
            if not alone:
                s = total + self.unknown_score
                if j + 1 not in back or (unigram and s > back[j + 1][2]):
                    back[j + 1] = (j, -1, s)
            if j % _CHECK_EVERY == _CHECK_EVERY - 1 and j + 1 < n:
                meet = self._common(back, j)
                if meet > base:
                    self._commit(text, back, base, meet, committed)
                    # the survivor at the meeting point stays, with the piece before it, as the new start
                    back = {k: v for k, v in back.items() if k >= meet}
                    base = meet
                    if trace is not None:
                        trace.append((j + 1 - meet, len(back)))
        self._commit(text, back, base, n, committed)

    @staticmethod
    def _common(back: dict, done: int) -> int:
        """The last boundary on the survivors of all live boundaries (those beyond ``done``)."""
        ends = sorted((k for k in back if k > done), reverse=True)
        at = set(ends)
        while len(at) > 1:
            top = max(at)
            at.discard(top)
            at.add(max(back[top][0], 0))
        return at.pop()

    def _commit(self, text: str, back: dict, base: int, end: int, committed: list[int]) -> None:
        path, k = [], end
        while k > base:
            start, i, _ = back[k]
            path.append((start, i))
            k = start
        for start, i in reversed(path):
            committed.extend([i] if i >= 0 else self._char_ids(text[start]))

    def _search_short(self, text: str) -> list[int]:
        """``search`` for a BPE model and a segment that needs no window: the same edges, plain lists."""
        n, compatible, trie = len(text), self.compatible, self.trie
        start, ids = [-1] * (n + 1), [-2] * (n + 1)
        start[0] = 0
        for j in range(n):
            if start[j] < 0:
                continue
            last, node, k, alone = ids[j], trie, j, False
            while k < n:
                node = node.get(text[k])
                if node is None:
                    break
                k += 1
                if "" in node:
                    i = node[""]
                    alone = alone or k == j + 1
                    if start[k] < 0 and i in self.stable:
                        if last >= 0:
                            ok = compatible.get(last * 1_048_576 + i)
                            if not (self._pair_stays(last, i) if ok is None else ok):
                                continue
                        start[k], ids[k] = j, i
            if not alone:
                start[j + 1], ids[j + 1] = j, -1
        out, k = [], n
        while k:
            j, i = start[k], ids[k]
            out.extend((i,) if i >= 0 else self._char_ids(text[j])[::-1])
            k = j
        out.reverse()
        return out

    # --- whole texts

    def _segment(self, segment: str) -> list[int]:
        out: list[int] = []
        if not self.unigram and len(segment) <= _REMEMBER and not segment.startswith(BLANK + BLANK):
            return self._search_short(segment)
        if self.unigram or not segment.startswith(BLANK + BLANK):
            self.search(segment, out)
            return out
        rest = segment.lstrip(BLANK)
        blanks, ids = len(segment) - len(rest), []
        if rest and not self.blanks_last:  # a model whose blanks merge with other characters, or before them
            blanks, rest = 0, ""
            merged = self.merged(segment)
        else:
            if rest:
                ids = np.frombuffer(self.memo[BLANK + rest], np.int32).tolist()
                alone = ids[0] == self.id_of[BLANK]
                ids, blanks = ids[alone:], blanks - (not alone)
            merged = self.merged(BLANK * blanks)
        for symbol in merged:
            out.extend([self.id_of[symbol]] if symbol in self.id_of else self._char_ids(symbol))
        return out + ids

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids of a text as native 32-bit integers."""
        if not text:
            return b""
        whole = BLANK + text.replace(" ", BLANK)
        if self.segments is None:
            return np.array(self._segment(whole), np.int32).tobytes()
        return b"".join(map(self.memo.__getitem__, self.segments(whole)))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def decode_bytes(self, ids: list[int]) -> bytes:
        whole = b"".join(map(self.surface.__getitem__, ids))
        return whole[1:] if whole[:1] == b" " else whole

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


class _Memo(dict):
    """segment -> ids; long segments are not kept, and all are forgotten when there are too many."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, segment: str) -> bytes:
        ids = np.array(self.model._segment(segment), np.int32).tobytes()
        if len(segment) <= _REMEMBER:
            if len(self) > _MEMO_LIMIT:
                self.clear()
            self[segment] = ids
        return ids


_LOADED: dict[str, PieceModel] = {}


def loaded(path: str) -> PieceModel:
    """The model of this Python worker, kept for its next tasks."""
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def _lists(parts: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """Per row: doc_id, n_tokens, ids, round_trip (whether decoding gives the text again; null for null)."""
    given = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        for batch in slices(batches, 500):  # ids of a large batch would take much memory
            pieces = pieces or loaded(model)
            texts = batch.column(1).to_pylist()
            parts = [pieces.encode_bytes(t) for t in texts]
            ok = [None if t is None else pieces.decode_bytes(np.frombuffer(p, np.int32).tolist()) == t.replace(BLANK, " ").encode("utf-8", "surrogatepass")
                  for t, p in zip(texts, parts, strict=True)]
            n = pa.array([len(p) // 4 for p in parts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, _lists(parts), pa.array(ok, pa.bool_())], ["doc_id", "n_tokens", "ids", "round_trip"])
        if pieces:
            pieces.memo.clear()  # an idle worker keeps the model only

    return given.mapInArrow(encoded, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """Per row: doc_id and the text of its ids (null for null; bytes that are no UTF-8 become U+FFFD)."""
    given = encoded.select(col(id_col).cast("long").alias("doc_id"), col(ids_col).cast("array<int>").alias("ids"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        for batch in slices(batches):
            pieces = pieces or loaded(model)
            texts = [None if ids is None else pieces.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return given.mapInArrow(decoded, "doc_id long, text string")
