"""Packing examples into sequences: vector bin packing with the dot-product heuristic.

A sequence is a bin with three limits at once: tokens, segments and loss-bearing tokens. A bin is filled
by taking again and again, of the examples that still fit all three limits, the one whose demand has the
largest dot product with what is left of them (Panigrahy et al. 2011). Texts may be cut: whole sequences
are cut off long ones first, only the rests are packed, and a bin that no rest fits is filled up with the
head of one. A bin that still isn't full (the segment limit, or the end of the data) is dealt into
sequences whose lengths are powers of two, so it needs no padding either.

Each task packs its own rows, a pool of rests at a time, so nothing is shuffled or gathered; only the
last pool of a task leaves sequences shorter than the limit.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.slabs import ragged

TOKENS = 2048
SEGMENTS = 256
# Tokens of the rests that are packed together.
POOL_TOKENS = 1_000_000
# Words whose token ids a worker remembers; started anew beyond that.
REMEMBERED_WORDS = 350_000
# Bytes of text that are split at once.
PIECE_BYTES = 4_000_000
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "loss_tokens long"
)


@dataclass(frozen=True)
class Limits:
    tokens: int = TOKENS
    segments: int = SEGMENTS
    loss: int = TOKENS

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("every limit must be at least 1")


def pack_texts(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    limits: Limits = Limits(),
) -> DataFrame:
    """One row per piece of a document in a sequence.

    ``doc_id, start, length`` say which of its ids, ``ids_crc32`` sums them up (little-endian 32-bit),
    ``doc_tokens`` counts all of them with the closing ``end_id``, ``sequence_id, offset`` say where the
    piece lies, ``loss_tokens`` how many of its ids bear loss (all). A null or empty text is its ``end_id``
    alone; rows without or with repeated ids are packed like all others; an empty table gives no pieces.
    Texts are cut freely and every id lies in exactly one piece.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _pack_texts(it, tokenizer, end_id, limits), _PIECES)


def pack_examples(
    examples: DataFrame, id_col: str, tokens_col: str, loss_col: str, limits: Limits = Limits()
) -> DataFrame:
    """``(id, sequence_id, offset)`` of whole examples, each one segment that is never cut.

    Null counts are 0. An example beyond a limit can't be placed: its ``sequence_id`` is null.
    """
    rows = examples.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)).alias("tokens"),
        F.coalesce(F.col(loss_col).cast("long"), F.lit(0)).alias("loss"),
    )
    return rows.mapInArrow(lambda it: _pack_examples(it, limits), "id long, sequence_id long, offset long")


class Demands:
    """Open rows by their demands: rows that ask for the same are one *kind*, so work goes with the kinds."""

    def __init__(self, demands: np.ndarray, capacity: np.ndarray, open_rows: np.ndarray | None = None) -> None:
        self.capacity = capacity.astype(np.float64)
        at = np.arange(len(demands)) if open_rows is None else np.flatnonzero(open_rows)
        self.kinds, kind = np.unique(demands[at].astype(np.float64), axis=0, return_inverse=True)
        order = np.argsort(kind.ravel(), kind="stable")
        self.left = np.bincount(kind.ravel(), minlength=len(self.kinds))
        # The rows of a kind in order, which is a heap.
        self.rows = [part.tolist() for part in np.split(at[order], np.cumsum(self.left)[:-1])]
        self.size = len(at)

    def take(self, kind: int, many: int = 1) -> list[int]:
        """The first rows of a kind."""
        self.left[kind] -= many
        self.size -= many
        return [heappop(self.rows[kind]) for _ in range(many)]

    def put(self, row: int, demand: np.ndarray) -> None:
        """A row that is open with a new demand."""
        found = np.flatnonzero((self.kinds == demand).all(axis=1))
        if len(found):
            heappush(self.rows[int(found[0])], row)
            self.left[found[0]] += 1
        else:
            self.kinds = np.vstack([self.kinds, demand])
            self.left = np.append(self.left, 1)
            self.rows.append([row])
        self.size += 1

    def fill(self) -> list[int]:
        """Takes the rows that go into one bin, in order; ties go to the earlier row."""
        room = self.capacity.copy()
        chosen: list[int] = []
        fits = (self.left > 0) & (self.kinds <= room).all(axis=1)
        while fits.any():
            at = np.flatnonzero(fits)
            kind, many = int(at[0]), 1
            if len(at) == 1:
                # Nothing else competes: as many as there is room for.
                asked = self.kinds[kind] > 0
                many = int(min([self.left[kind], *(room[asked] // self.kinds[kind][asked])]))
            else:
                scores = (self.kinds[at] / self.capacity) @ (room / self.capacity)
                tied = at[scores == scores.max()].tolist()
                kind = min(tied, key=lambda k: self.rows[k][0])
            chosen += self.take(kind, many)
            room -= many * self.kinds[kind]
            fits &= (self.left > 0) & (self.kinds <= room).all(axis=1)
        return chosen


def fill_bin(demands: np.ndarray, capacity: np.ndarray, open_rows: np.ndarray) -> list[int]:
    """Rows of ``demands`` that go into one bin, in order; ``open_rows`` marks those not yet placed.

    Ties go to the earlier row.
    """
    return Demands(demands, capacity, open_rows).fill()


def powers_of_two(n: int) -> list[int]:
    """The powers of two that add up to ``n``, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class WordTokens:
    """Token ids of words, remembered; a text's ids are those of its blank-separated words.

    Exact for this tokenizer, whose normalizer and splitting never look across a blank. It also splits
    between letters and punctuation and lowers letters one by one, so a word of plain letters with
    punctuation behind it has the ids of both, and plain letters can go to the merges directly.
    """

    PUNCTUATION = b".,!?;:%&*#$|"

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.parts: dict[bytes, list[int]] = {}
        # The merges work on one printable character a byte; the pre-tokenizer knows which.
        from tokenizers.pre_tokenizers import ByteLevel

        level = ByteLevel(add_prefix_space=False, use_regex=False)
        plain = [chr(k) for k in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250))]
        plain = [c for c in plain if c.isalpha() and len(c.lower()) == 1]
        self.written = {ord(c): level.pre_tokenize_str(c.lower())[0][0] for c in plain}
        self.plain = frozenset(plain)
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)

    def _part(self, part: bytes) -> list[int]:
        """The ids of a word or of one side of it."""
        found = self.parts.get(part)
        if found is None:
            text = part.decode()
            if self.plain.issuperset(text):
                found = [t.id for t in self.merges.tokenize(text.translate(self.written))]
            else:
                found = self.tokenizer.encode(text, add_special_tokens=False).ids
            self.parts[part] = found
        return found

    def _all_ids(self, words: list[bytes]) -> list[list[int]]:
        if len(self.parts) >= REMEMBERED_WORDS:
            self.parts.clear()
        found = []
        get, merges, punctuation = self.parts.get, self.merges.tokenize, self.PUNCTUATION
        for word in words:
            front = word.rstrip(punctuation)
            tail = word[len(front) :]
            if front.isalpha():  # plain ASCII letters, the usual case
                front = front.lower()
                ids = get(front)
                if ids is None:
                    ids = self.parts[front] = [t.id for t in merges(front.decode())]
                found.append(ids + self._part(tail) if tail else ids)
            elif tail and front and front.decode()[-1] in self.plain:
                found.append(self._part(front) + self._part(tail))
            else:
                found.append(self._part(word))
        return found

    def of(self, words: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words ``words[k] for k in at``, and how many ids each has."""
        get = self.index.get
        known = np.array([get(word, -1) for word in words], np.int64)
        missing = np.flatnonzero(known < 0)
        if len(missing):
            if len(self.index) + len(missing) > REMEMBERED_WORDS and self.index:
                self.clear()
                missing = np.arange(len(words))
            new = [words[k] for k in missing.tolist()]
            found = self._all_ids(new)
            size = len(self.index)
            self.starts = _grown(self.starts, size + len(new) + 1)
            ends = self.starts[size] + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
            self.ids = _grown(self.ids, int(ends[-1]))
            self.ids[self.starts[size] : ends[-1]] = np.fromiter(chain.from_iterable(found), np.uint32)
            self.starts[size + 1 : size + 1 + len(new)] = ends
            known[missing] = np.arange(size, size + len(new))
            self.index.update(zip(new, range(size, size + len(new)), strict=True))
        at = known[at]
        lens = self.starts[at + 1] - self.starts[at]
        return self.ids[ragged(self.starts[at], lens)], lens


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """An array that holds at least ``size`` values, doubled if it must grow."""
    if size <= len(array):
        return array
    found = np.zeros(max(size, 2 * len(array)), array.dtype)
    found[: len(array)] = array
    return found


_WORDS: dict[str, WordTokens] = {}


def _word_tokens(path: str) -> WordTokens:
    """One per worker and file."""
    if path not in _WORDS:
        _WORDS[path] = WordTokens(path)
    return _WORDS[path]


def pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with about ``size`` bytes of text in the second column."""
    for batch in batches:
        if batch.num_rows:
            lens = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
            group = np.cumsum(lens) // size
            first = np.append(np.flatnonzero(np.diff(group, prepend=-1)), batch.num_rows)
            for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                yield batch.slice(a, z - a)


def tokenized(column: pa.Array, tokenizer: WordTokens, end_id: int) -> Iterator[np.ndarray]:
    """Each text's ids with ``end_id`` behind them; a null text is empty."""
    split = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    coded = split.flatten().dictionary_encode()
    # Some words are empty, at either end of a text; they have no ids.
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    ids, lens = tokenizer.of(words, coded.indices.to_numpy().astype(np.int64))
    ends = np.append(0, np.cumsum(lens))[np.cumsum(split.value_lengths().to_numpy())]
    begin = 0
    for end in ends.tolist():
        yield np.append(ids[begin:end], np.uint32(end_id))
        begin = end


@dataclass
class _Packer:
    """The pieces of one task: whole sequences at once, rests by pools."""

    limits: Limits
    first: int
    rests: list[list] = field(default_factory=list)
    tokens: int = 0
    sequences: int = 0
    rows: list[tuple] = field(default_factory=list)

    def add(self, id_: int | None, ids: np.ndarray) -> None:
        whole = min(self.limits.tokens, self.limits.loss)
        start = len(ids) // whole * whole
        for at in range(0, start, whole):
            self._dealt([(id_, ids, at, whole)])
        if start < len(ids):
            self.rests.append([id_, ids, start, len(ids) - start])
            self.tokens += len(ids) - start
        if self.tokens >= POOL_TOKENS:
            self.pack(last=False)

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for id_, ids, start, length in pieces:
            crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
            self.rows.append((id_, start, length, crc, len(ids), self.first + self.sequences, offset, length))
            offset += length
        self.sequences += 1

    def _dealt(self, pieces: list[tuple]) -> None:
        """A bin as one sequence if it is full, else as sequences of powers of two."""
        total = sum(piece[3] for piece in pieces)
        if total == self.limits.tokens:
            self._sequence(pieces)
            return
        queue = [list(piece) for piece in reversed(pieces)]
        for size in powers_of_two(total):
            taken = []
            while size:
                id_, ids, start, length = queue[-1]
                part = min(size, length)
                taken.append((id_, ids, start, part))
                size -= part
                queue[-1][2:] = [start + part, length - part]
                if part == length:
                    queue.pop()
            self._sequence(taken)

    def pack(self, last: bool) -> None:
        """Fill bins from the pool; unless it is the last one, what fills no bin waits for the next pool."""
        limit = min(self.limits.tokens, self.limits.loss)
        capacity = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], np.float64)
        lens = np.array([rest[3] for rest in self.rests], np.float64)
        # All ids of a text bear loss.
        pool = Demands(np.stack([lens, np.ones(len(lens)), lens], axis=1), capacity)
        tokens = self.tokens
        while pool.size and (last or tokens >= limit):
            chosen = pool.fill()
            pieces = [tuple(self.rests[k]) for k in chosen]
            left = limit - sum(piece[3] for piece in pieces)
            if left and len(chosen) < self.limits.segments and pool.size:
                # Nothing fits any more: the head of the longest rest fills the bin.
                kind = int(np.argmax(np.where(pool.left > 0, pool.kinds[:, 0], -1)))
                k = pool.take(kind)[0]
                id_, ids, start, length = self.rests[k]
                cut = min(left, length)
                pieces.append((id_, ids, start, cut))
                if cut < length:
                    self.rests[k] = [id_, ids, start + cut, length - cut]
                    pool.put(k, np.array([length - cut, 1, length - cut], np.float64))
            tokens -= sum(piece[3] for piece in pieces)
            self._dealt(pieces)
        self.rests = [self.rests[k] for k in sorted(chain.from_iterable(pool.rows))]
        self.tokens = tokens

    def flushed(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[] for _ in range(8)]
        self.rows = []
        names = [part.split()[0] for part in _PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)


def _first_sequence() -> int:
    """Sequence numbers of a task start at its partition's share of the 64-bit numbers."""
    context = TaskContext.get()
    return (context.partitionId() if context else 0) << 36


def _pack_texts(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, limits: Limits
) -> Iterator[pa.RecordBatch]:
    tokenizer = _word_tokens(path)
    packer = _Packer(limits, _first_sequence())
    for piece in pieces(batches, PIECE_BYTES):
        for id_, ids in zip(piece.column(0).to_pylist(), tokenized(piece.column(1), tokenizer, end_id), strict=True):
            packer.add(id_, ids)
        yield packer.flushed()
    packer.pack(last=True)
    yield packer.flushed()


def _pack_examples(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    capacity = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
    sequence = _first_sequence()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        tokens, loss = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        demands = np.stack([tokens, np.ones(len(ids)), loss], axis=1).astype(np.float64)
        fitting = (demands <= capacity).all(axis=1)
        placed: list[tuple] = [(ids[k], None, None) for k in np.flatnonzero(~fitting)]
        pool = Demands(demands, capacity, fitting)
        while pool.size:
            offset = 0
            for k in pool.fill():
                placed.append((ids[k], sequence, offset))
                offset += int(tokens[k])
            sequence += 1
        columns = list(zip(*placed, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.int64()) for c in columns], ["id", "sequence_id", "offset"]
        )
