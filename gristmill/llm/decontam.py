"""Benchmark decontamination by a positional inverted index of the corpus.

The index is split by document, as search engines do it: a task turns about a million words into one
*segment*, which holds for each benchmark term the sorted list of its positions, so all lists that a
phrase needs lie together and matching shuffles nothing, whatever term or document is hot. Global term
counts come from the segments. Phrases are then matched from their rarest term: its list, moved back by
the term's offset, gives candidate starts, which are intersected with the lists of the next rarer terms,
each moved by its own offset, until no term is left. What remains is an exact match; no text is read again.

The benchmark is dealt into blocks of at most about ``BLOCK_BYTES`` of text; the terms and phrases of one
block are sent to the tasks, so their size is bounded whatever the benchmark's is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.slabs import SLAB_WORDS, bundled, ragged, texts
from gristmill.session import Scope

WINDOW = 13
BLOCK_BYTES = 4_000_000
# Candidate starts that are held at once.
CANDIDATES = 2_000_000

# A-Z become a-z; digits, letters and every byte of a non-ASCII character stay; the rest is blank.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_SEGMENT = "ids array<long>, prints array<long>, lens array<int>, terms array<int>, counts array<int>, places binary"
_MATCHES = (
    "id long, print long, n_words long, n_hit long, items array<long>, starts array<int>, ends array<int>"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases of one benchmark block: term numbers by length, and the items they come from."""

    terms: dict[bytes, int]
    by_length: dict[int, tuple[np.ndarray, list[np.ndarray]]]


def phrases(items: list[tuple[int, str]], window: int = WINDOW) -> Phrases:
    """All windows of ``window`` words of the items; a shorter item is one window, one without words none."""
    terms: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[int]] = {}
    for item, text in items:
        numbers = [terms.setdefault(w, len(terms)) for w in words_of((text or "").encode())]
        size = min(window, len(numbers))
        for p in range(len(numbers) - size + 1 if size else 0):
            found.setdefault(tuple(numbers[p : p + size]), set()).add(item)
    by_length = {}
    for size in sorted({len(key) for key in found}):
        keys = [key for key in found if len(key) == size]
        by_length[size] = np.array(keys, np.int32), [np.array(sorted(found[key]), np.int64) for key in keys]
    return Phrases(terms, by_length)


def benchmark_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items with an id, in blocks of about ``BLOCK_BYTES`` of text that fit on the driver."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    blocks = 1 + 2 * size // BLOCK_BYTES
    for block in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        yield [tuple(row) for row in part.collect()]


def segments(docs: DataFrame, id_col: str, text_col: str, terms: dict[bytes, int]) -> DataFrame:
    """The index: one row per segment with its documents, its terms and their positions."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _index(it, terms), _SEGMENT)


def term_counts(index: DataFrame, size: int) -> np.ndarray:
    """How often each of ``size`` terms occurs in the corpus."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1), strict=True):
                total[terms.values.to_numpy()] += counts.values.to_numpy()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int32()), "count": pa.array(total[at], pa.int64())})

    found = index.select("terms", "counts").mapInArrow(partial, "term int, count long")
    counts = np.zeros(size, np.int64)
    for term, count in found.groupBy("term").agg(F.sum("count")).collect():
        counts[term] = count
    return counts


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> tuple[DataFrame, Scope]:
    """One row per row of ``docs``: ``(id, print, n_words, n_hit, items, starts, ends)`` and the staged tables' owner.

    ``print`` is a hash of the text, ``starts`` and ``ends`` bound the maximal runs of hit words, ``items``
    are those with an occurring window. A null text has no words. Rows without id and repeated rows get
    results of their own; items that share an id count as one; items without id or words match nothing.
    """
    scope = Scope(docs.sparkSession)
    found = []
    for block in benchmark_blocks(items, item_id_col, item_text_col):
        of = phrases(block, window)
        index = scope.stage(segments(docs, id_col, text_col, of.terms), "segments")
        counts = term_counts(index, len(of.terms))
        found.append(index.mapInArrow(lambda it, of=of, counts=counts: _match(it, of, counts), _MATCHES))
    if len(found) == 1:
        return found[0], scope
    # Rows that agree in id and text agree in everything; each block has all of them.
    merged = reduce(DataFrame.unionAll, found).groupBy("id", "print", "n_words").agg(
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.flatten(F.collect_list("starts")).alias("starts"),
        F.flatten(F.collect_list("ends")).alias("ends"),
        (F.count(F.lit(1)) / len(found)).cast("int").alias("rows"),
    )
    whole = merged.withColumn("row", F.explode(F.array_repeat(F.lit(0), F.col("rows")))).drop("row", "rows")
    names = ["id", "print", "n_words", "items", "starts", "ends"]
    return whole.select(*names).mapInArrow(_united, _MATCHES), scope


def contaminated(n_hit: Column, n_words: Column, least_share: int = 20) -> Column:
    """A document is contaminated if at least one word in ``least_share`` is hit, and one at all."""
    return (n_hit > 0) & (n_hit * least_share >= n_words)


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns unchanged."""
    found, _ = matches(docs, items, id_col, text_col)
    bad = found.filter(contaminated(F.col("n_hit"), F.col("n_words"))).select("id", "print").distinct()
    # Columns of docs travel in one, so that they may bear any name.
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = docs.select(F.col(id_col).cast("long").alias("own_id"), F.xxhash64(text).alias("own_print"), bundled(docs).alias("row"))
    own = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_print") == F.col("print"))
    return marked.join(bad, own, "left_anti").select(*[F.col("row")[name].alias(name) for name in docs.columns])


def proximity_matches(index: DataFrame, of: Phrases, counts: np.ndarray, slop: int) -> DataFrame:
    """``(id, item, place)``: where all terms of a phrase lie within ``slop`` words of its rarest one, in any order.

    ``place`` is the position of the rarest term in its document.
    """
    return index.mapInArrow(lambda it: _near(it, of, counts, slop), "id long, item long, place long")


def _index(batches: Iterator[pa.RecordBatch], terms: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    ids: list = []
    prints: list[int] = []
    lens: list[int] = []
    parts: list[np.ndarray] = []
    size = 0
    get = terms.get

    def made() -> pa.RecordBatch:
        flat = np.concatenate(parts)
        at = np.flatnonzero(flat >= 0)
        order = np.argsort(flat[at], kind="stable")
        at = at[order]
        used, counts = np.unique(flat[at], return_counts=True)
        return pa.RecordBatch.from_pydict(
            {
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "prints": pa.array([prints], pa.list_(pa.int64())),
                "lens": pa.array([lens], pa.list_(pa.int32())),
                "terms": pa.array([used], pa.list_(pa.int32())),
                "counts": pa.array([counts], pa.list_(pa.int32())),
                "places": pa.array([at.astype(np.uint32).tobytes()], pa.binary()),
            }
        )

    for piece, values in texts(batches):
        ids.extend(piece.column(0).to_pylist())
        words: list[bytes] = []
        for value in values:
            # The hash that Spark's xxhash64 gives for a string.
            prints.append((xxhash.xxh64_intdigest(value, 42) + (1 << 63)) % (1 << 64) - (1 << 63))
            found = value.translate(_WORDS).split()
            lens.append(len(found))
            words += found
        parts.append(np.array([get(w, -1) for w in words], np.int32))
        size += len(words)
        if size >= SLAB_WORDS:
            yield made()
            ids, prints, lens, parts, size = [], [], [], [], 0
    if ids:
        yield made()


@dataclass
class _Segment:
    """One row of the index, ready for look-ups."""

    ids: list
    prints: list
    lens: np.ndarray
    first: np.ndarray
    count: np.ndarray
    places: np.ndarray
    keys: np.ndarray

    @classmethod
    def read(cls, batches: Iterator[pa.RecordBatch], size: int) -> Iterator[_Segment]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {name: batch.column(i)[row] for i, name in enumerate(batch.schema.names)}
                terms, own = get["terms"].values.to_numpy(), get["counts"].values.to_numpy()
                places = np.frombuffer(get["places"].as_py(), np.uint32).astype(np.int64)
                first, count = np.zeros(size, np.int64), np.zeros(size, np.int64)
                first[terms], count[terms] = np.cumsum(own) - own, own
                keys = (np.repeat(terms.astype(np.int64), own) << 32) | places
                lens = get["lens"].values.to_numpy().astype(np.int64)
                yield cls(get["ids"].as_py(), get["prints"].as_py(), lens, first, count, places, keys)

    def has(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        wanted = (terms.astype(np.int64) << 32) | np.maximum(places, 0)
        at = np.minimum(np.searchsorted(self.keys, wanted), max(0, len(self.keys) - 1))
        return (self.keys[at] == wanted) & (places >= 0) if len(self.keys) else np.zeros(len(wanted), bool)

    def occurrences(self, table: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(phrase, start)`` of all places where phrases of one length occur inside one document."""
        size = table.shape[1]
        ends = np.cumsum(self.lens)
        by_rarity = np.argsort(counts[table], axis=1, kind="stable")
        rows = np.arange(len(table))
        rarest = table[rows, by_rarity[:, 0]]
        length = self.count[rarest]
        alive = np.flatnonzero(self.count[table].min(axis=1) > 0)
        groups = np.split(alive, np.flatnonzero(np.diff(np.cumsum(length[alive]) // CANDIDATES)) + 1) if len(alive) else []
        for group in groups:
            phrase = np.repeat(group, length[group])
            start = self.places[ragged(self.first[rarest[group]], length[group])] - by_rarity[phrase, 0]
            for k in range(1, size):
                offset = by_rarity[phrase, k]
                same = self.has(table[phrase, offset], start + offset)
                phrase, start = phrase[same], start[same]
            inside = start >= 0
            phrase, start = phrase[inside], start[inside]
            doc = np.searchsorted(ends, start, side="right")
            whole = start + size <= ends[doc] if len(doc) else np.zeros(0, bool)
            yield phrase[whole], start[whole]


def _match(batches: Iterator[pa.RecordBatch], of: Phrases, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for segment in _Segment.read(batches, len(of.terms)):
        total = int(segment.lens.sum())
        ends = np.cumsum(segment.lens)
        depth = np.zeros(total + 1, np.int64)
        items: dict[int, set[int]] = {}
        for size, (table, sources) in of.by_length.items():
            for phrase, start in segment.occurrences(table, counts):
                depth += np.bincount(start, minlength=total + 1) - np.bincount(start + size, minlength=total + 1)
                doc = np.searchsorted(ends, start, side="right")
                for d, p in np.unique(np.stack([doc, phrase], axis=1), axis=0).tolist() if len(doc) else []:
                    items.setdefault(d, set()).update(sources[p].tolist())
        covered = np.cumsum(depth[:-1]) > 0
        begins = ends - segment.lens
        before = np.append(0, np.cumsum(covered))
        n_hit = before[ends] - before[begins]
        starts, stops = [], []
        for d, hit in enumerate(n_hit.tolist()):
            if not hit:
                starts.append([])
                stops.append([])
                continue
            step = np.diff(covered[begins[d] : ends[d]].astype(np.int8), prepend=0, append=0)
            starts.append(np.flatnonzero(step == 1).tolist())
            stops.append(np.flatnonzero(step == -1).tolist())
        yield pa.RecordBatch.from_pydict(
            {
                "id": pa.array(segment.ids, pa.int64()),
                "print": pa.array(segment.prints, pa.int64()),
                "n_words": pa.array(segment.lens, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "items": pa.array([sorted(items.get(d, ())) for d in range(len(segment.ids))], pa.list_(pa.int64())),
                "starts": pa.array(starts, pa.list_(pa.int32())),
                "ends": pa.array(stops, pa.list_(pa.int32())),
            }
        )


def _near(
    batches: Iterator[pa.RecordBatch], of: Phrases, counts: np.ndarray, slop: int
) -> Iterator[pa.RecordBatch]:
    for segment in _Segment.read(batches, len(of.terms)):
        ends = np.cumsum(segment.lens)
        begins = ends - segment.lens
        rows = []
        for table, sources in of.by_length.values():
            for phrase, sequence in enumerate(table):
                terms = np.unique(sequence)
                rarest = terms[np.argmin(counts[terms])]
                at = segment.places[segment.first[rarest] : segment.first[rarest] + segment.count[rarest]]
                doc = np.searchsorted(ends, at, side="right")
                for term in terms[terms != rarest]:
                    own = segment.places[segment.first[term] : segment.first[term] + segment.count[term]]
                    low = np.maximum(at - slop, begins[doc])
                    high = np.minimum(at + slop, ends[doc] - 1)
                    near = np.searchsorted(own, low) < np.searchsorted(own, high, side="right")
                    at, doc = at[near], doc[near]
                rows += [
                    (segment.ids[d], item, place)
                    for d, place in zip(doc.tolist(), (at - begins[doc]).tolist(), strict=True)
                    for item in sources[phrase].tolist()
                ]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        names = ["id", "item", "place"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of hit words of several blocks as maximal runs."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            runs: list[list[int]] = []
            for start, end in sorted(zip(row["starts"], row["ends"], strict=True)):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([start, end])
            row |= {"n_hit": sum(e - s for s, e in runs), "starts": [s for s, _ in runs], "ends": [e for _, e in runs]}
            row["items"] = sorted(row["items"])
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
        names = ["id", "print", "n_words", "n_hit", "items", "starts", "ends"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[n] for row in rows], kind) for n, kind in zip(names, kinds, strict=True)], names
        )
