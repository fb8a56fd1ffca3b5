"""Words of many texts as flat numpy arrays, and packed rows between tasks.

A *slab* is a run of whole documents with about ``SLAB_WORDS`` words. Word work is done on flat arrays
of one slab; what leaves a task is packed: one row per slab and bucket that carries arrays as bytes, so
Spark shuffles a few large rows instead of one row per word. A slab is only a unit of work: results
never depend on how documents fall into slabs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame

SLAB_WORDS = 1_000_000
# Words whose hashes a Python worker remembers; the memory is started anew beyond that.
REMEMBERED_WORDS = 400_000
# Texts taken from an Arrow batch at once, so that few Python objects are alive.
ROWS = 256

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _powers(base: int, n: int) -> np.ndarray:
    found = np.full(n + 1, base, np.uint64)
    found[0] = 1
    return np.multiply.accumulate(found)


class ByteHashes:
    """64-bit hashes of all words of a buffer at once: polynomials in an odd number, one drawn value a byte.

    Prefix sums of the polynomials are taken window by window, so a word may span windows and memory does not
    follow the length of a text or a word.
    """

    WINDOW = 1 << 18
    _STEP = 0xC2B2AE3D27D4EB4D

    def __init__(self, lower: bool = False):
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
        if lower:
            self.values[ord("A") : ord("Z") + 1] = self.values[ord("a") : ord("z") + 1]
        self.word = np.ones(256, np.int8)
        for blank in b" \t\n\v\f\r":
            self.values[blank], self.word[blank] = 0, 0
        self.up = _powers(self._STEP, self.WINDOW)
        self.down = _powers(pow(self._STEP, -1, 1 << 64), self.WINDOW)

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of ``data``, which ends in a blank, start, and their hashes."""
        buffer = np.frombuffer(data, np.uint8)
        total, up, down, inside = 0, 1, 1, 0
        places, prefixes, backs = [], [], []
        for at in range(0, len(buffer), self.WINDOW):
            part = buffer[at : at + self.WINDOW]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.values[part] * self.up[: len(part)], out=sums[1:])
            word = self.word[part]
            change = np.flatnonzero(np.diff(word, prepend=np.int8(inside)))
            places.append(change + at)
            prefixes.append(sums[change] * np.uint64(up) + np.uint64(total))
            backs.append(self.down[change] * np.uint64(down))
            inside = word[-1]
            total = (total + up * int(sums[-1])) & _MASK
            up, down = up * int(self.up[-1]) & _MASK, down * int(self.down[-1]) & _MASK
        place, prefix, back = (np.concatenate(x) if x else np.empty(0, np.uint64) for x in (places, prefixes, backs))
        return place[::2], (prefix[1::2] - prefix[::2]) * back[::2]


@dataclass
class Slab:
    """Documents in ascending order of id: ids, words per document, and the hashes of all words."""

    ids: np.ndarray
    lens: np.ndarray
    hashes: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lens) - self.lens

    def doc(self) -> np.ndarray:
        """The index of each word's document."""
        return np.repeat(np.arange(len(self.lens)), self.lens)

    def place(self) -> np.ndarray:
        """The position of each word in its document."""
        return np.arange(len(self.hashes)) - np.repeat(self.starts, self.lens)


def texts(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Pieces of the batches with their texts as UTF-8 bytes; a null text is empty."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            piece = batch.slice(start, ROWS)
            values = piece.column(piece.schema.get_field_index(column)).cast(pa.large_binary()).to_pylist()
            yield piece, [value or b"" for value in values]


def slabs(
    batches: Iterable[pa.RecordBatch], lower: bool = False, extra: str | None = None, whole: bool = False, most: int = SLAB_WORDS
) -> Iterator[tuple[Slab, list]]:
    """Slabs of ``(id, text)`` rows; words are runs of non-blank bytes. Rows have non-null ids.

    ``extra`` names a column whose values come along, in the slab's order. ``whole`` hashes buffers instead of
    word after word: several times faster where most words are rare, with other hashes. A slab is given out once
    it has ``most`` words.
    """
    known = ByteHashes(lower) if whole else WordHashes()
    ids: list[int] = []
    lens: list[int] = []
    parts: list[np.ndarray] = []
    carried: list = []
    size = 0

    def made() -> tuple[Slab, list]:
        number, count = np.array(ids, np.int64), np.array(lens, np.int64)
        flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        order = np.argsort(number, kind="stable")
        if not np.array_equal(order, np.arange(len(order))):
            start = np.cumsum(count) - count
            flat = flat[ragged(start[order], count[order])]
            number, count = number[order], count[order]
        return Slab(number, count, flat), [carried[i] for i in order] if extra else []

    for piece, values in texts(batches):
        ids.extend(piece.column(piece.schema.get_field_index("id")).to_pylist())
        if extra:
            carried.extend(piece.column(piece.schema.get_field_index(extra)).to_pylist())
        if whole:
            places, hashes = known.of(b" ".join([*values, b""]))
            borders = np.cumsum([0, *(len(value) + 1 for value in values)])
            lens.extend(np.diff(np.searchsorted(places, borders)).tolist())
            parts.append(hashes)
        else:
            words: list[bytes] = []
            for value in values:
                found = (value.translate(LOWER) if lower else value).split()
                lens.append(len(found))
                words += found
            parts.append(known.of(words))
        size += len(parts[-1])
        if size >= most:
            yield made()
            ids, lens, parts, carried, size = [], [], [], [], 0
    if ids:
        yield made()


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The concatenation of ``range(start, start + len)`` over all pairs."""
    total = int(lens.sum())
    before = np.cumsum(lens) - lens
    return np.arange(total) + np.repeat(starts - before, lens)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Mixed 64-bit hashes of all ``n`` consecutive words, document borders ignored."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    size = len(hashes) - n + 1
    found = hashes[:size].copy()
    for k in range(1, n):
        found *= np.uint64(_BASE)
        found += hashes[k : k + size]
    return mix(found ^ _ODD)


def edges(buckets: int) -> np.ndarray:
    """The first key of each of ``buckets`` even ranges of 64-bit keys."""
    return np.array([(k << 64) // buckets for k in range(buckets)], np.uint64)


def cut(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Borders of the buckets in sorted keys: bucket b is ``keys[border[b]:border[b + 1]]``."""
    return np.append(np.searchsorted(keys, edges(buckets)), len(keys))


def bucket_count(df: DataFrame) -> int:
    """As many buckets as the session deals its shuffles to, which is set to follow the data."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)`` of the rows with an id."""
    from pyspark.sql import functions as F

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.filter(F.col("id").isNotNull())


def bundled(docs: DataFrame, *apart: str) -> Column:
    """All columns but those ``apart`` as one, so that columns an operator adds can't clash with them."""
    from pyspark.sql import functions as F

    names = [name for name in docs.columns if name not in apart]
    quoted = [F.col(f"`{name.replace('`', '``')}`").alias(name) for name in names]
    return F.struct(*quoted) if quoted else F.struct(F.lit(None).cast("int").alias("none"))


def from_bytes(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """All arrays of a binary column as one."""
    parts = [value for value in column.to_pylist() if value]
    return np.frombuffer(b"".join(parts), kind)


def lengths(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.array([len(value or b"") // size for value in column.to_pylist()], np.int64)


def per_document(doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Values grouped by document: the documents, and each one's values as bytes."""
    if not len(doc):
        return doc, []
    order = np.argsort(doc, kind="stable")
    doc, values = doc[order], values[order]
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    return doc[first], [part.tobytes() for part in np.split(values, first[1:])]
