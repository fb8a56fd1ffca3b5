"""Substring dedup: remove word windows that also occur earlier in the corpus.

Fixed-block anchors. Every document is cut into non-overlapping *reference blocks* of half a window;
any occurrence of a window contains at least one whole block. The blocks are indexed by hash and probed
with every rolling window of block length of the whole corpus, so a block that nothing else contains
costs one look-up and is done. Around the blocks that were hit, the hits are extended word by word to
the maximal runs that repeat exactly: each window inside them is compared as a whole with all others
and the earliest occurrence is found.

No step lists pairs: a passage that a third of all documents share is a block hit per document, and
its windows meet in one minimum. Before each shuffle a task keeps one entry per distinct key, so a hot
key reaches its bucket once per slab of about a million words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.slabs import (
    bucket_count,
    bundled,
    cut,
    edges,
    from_bytes,
    identified,
    per_document,
    rolling,
    slabs,
    texts,
)
from gristmill.session import Scope

WINDOW = 20
# Bits of a block hash that are compared inside a bucket. A chance agreement only costs work, since
# windows are compared by 80 bits afterwards.
_PROBE_BITS = 40
_PROBES = "bucket int, probes binary, many binary, keys binary, docs binary, places binary"
_WINDOWS = "bucket int, keys binary, more binary, docs binary, places binary"
_PARTS = "part int, docs binary, places binary"
_PLACES = "id long, places binary"


def repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> tuple[DataFrame, Scope]:
    """``(id, starts)``: per document the starts (int32 bytes) of windows that occur earlier.

    Earlier is a smaller id, or the same document at an earlier start. Rows without an id take no
    part, null and short texts have no window, and rows that share an id count as one place. The
    second result owns the staged tables.
    """
    block = window // 2
    scope = Scope(docs.sparkSession)
    rows = identified(docs, id_col, text_col)
    buckets = bucket_count(docs)
    probed = rows.mapInArrow(lambda it: _probe(it, block, buckets), _PROBES)
    hit = probed.groupBy("bucket").applyInArrow(lambda key, table: _hits(key, table, buckets), _PARTS)
    hits = scope.stage(hit.groupBy("part").applyInArrow(_by_document, _PLACES), "block_hits").toDF("id", "hits")
    extended = rows.join(hits, "id").mapInArrow(lambda it: _extend(it, window, block, buckets), _WINDOWS)
    later = extended.groupBy("bucket").applyInArrow(lambda key, table: _later(key, table, buckets), _PARTS)
    repeats = scope.stage(later.groupBy("part").applyInArrow(_by_document, _PLACES), "repeats")
    return repeats.toDF("id", "starts"), scope


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_words``, ``n_removed`` and ``kept_sha256``.

    Words are runs of non-blank characters (space, tab to carriage return), unchanged. Words inside
    any window that occurs earlier are removed; ``kept_text`` is the text itself if nothing was
    removed, else the kept words joined by one space. A null text has no words and stays null; an
    empty table gives an empty result; rows without an id are kept as they are. Other columns pass
    through; one that bears one of the four names is replaced.
    """
    repeats, _ = repeated_windows(docs, id_col, text_col, window)
    # Columns of docs travel in one, so that they may bear any name; the text travels once.
    left = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), bundled(docs, text_col).alias("row")
    )
    joined = left.join(repeats, "id", "left").select("row", "text", "starts")
    schema = joined.select("row", "text").schema
    for name, kind in (("kept_text", "string"), ("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string")):
        schema = schema.add(name, kind)
    out = joined.mapInArrow(lambda it: _removed(it, window), schema)
    names = [f.name for f in schema.fields[2:]]
    own = [
        (F.col("text").cast(docs.schema[name].dataType) if name == text_col else F.col("row")[name]).alias(name)
        for name in docs.columns if name not in names
    ]
    return out.select(*own, *names)


def _probe(batches: Iterator[pa.RecordBatch], block: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per slab: the distinct hashes of all rolling windows, and the reference blocks to look up."""
    borders = edges(buckets)
    for slab, _ in slabs(batches):
        if len(slab.hashes) < block:
            continue
        place = slab.place()
        left = np.repeat(slab.lens, slab.lens) - place
        size = len(slab.hashes) - block + 1
        valid = left[:size] >= block
        keys = rolling(slab.hashes, block)
        at = np.flatnonzero(valid & (place[:size] % block == 0))
        block_keys = keys[at]
        block_docs = np.repeat(slab.ids, slab.lens)[at]
        block_places = place[at].astype(np.int32)
        found, counts = np.unique(keys[valid], return_counts=True)
        many = counts > 1
        known = many[np.searchsorted(found, block_keys)]
        # Blocks that repeat inside the slab are decided; one of each goes on to tell the others.
        yield from _decided(block_docs[known], block_places[known], buckets)
        order = np.argsort(block_keys[~known], kind="stable")
        block_keys, block_docs, block_places = (x[~known][order] for x in (block_keys, block_docs, block_places))
        all_at, some_at, block_at = cut(found, buckets), cut(found[many], buckets), cut(block_keys, buckets)
        repeated = found[many]
        rows = []
        for b in range(buckets):
            own, own_many = found[all_at[b] : all_at[b + 1]], repeated[some_at[b] : some_at[b + 1]]
            if not len(own):
                continue
            part = slice(block_at[b], block_at[b + 1])
            by_place = np.lexsort((block_places[part], block_docs[part]))
            rows.append((b, _packed(own, borders[b], buckets), _packed(own_many, borders[b], buckets),
                         _packed(block_keys[part][by_place], borders[b], buckets),
                         block_docs[part][by_place].tobytes(), block_places[part][by_place].tobytes()))
        yield _batch(rows, _PROBES)


def _packed(keys: np.ndarray, first: np.uint64, buckets: int) -> bytes:
    """Keys of one bucket, five bytes each: four and one, so that each plane compresses."""
    shift = np.uint64(max(0, 64 - (buckets.bit_length() - 1) - _PROBE_BITS))
    short = (keys - first) >> shift
    return (short >> np.uint64(8)).astype(np.uint32).tobytes() + short.astype(np.uint8).tobytes()


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    found = []
    for value in column.to_pylist():
        n = len(value) // 5
        high = np.frombuffer(value, np.uint32, n).astype(np.uint64)
        found.append((high << np.uint64(8)) | np.frombuffer(value, np.uint8, n, 4 * n))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _decided(docs: np.ndarray, places: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Results that need no bucket, spread over negative bucket numbers."""
    if not len(docs):
        return
    spread = docs % buckets
    order = np.argsort(spread, kind="stable")
    spread, docs, places = spread[order], docs[order], places[order].astype(np.int32)
    first = np.append(np.flatnonzero(np.append(True, spread[1:] != spread[:-1])), len(spread))
    rows = [(-1 - int(spread[a]), b"", b"", b"", docs[a:z].tobytes(), places[a:z].tobytes())
            for a, z in zip(first[:-1], first[1:], strict=True)]
    yield _batch(rows, _PROBES)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    arrays = [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _parted(docs: np.ndarray, places: np.ndarray, parts: int) -> pa.Table:
    """Places by the remainder of their document, one row each."""
    part = docs % parts
    order = np.argsort(part, kind="stable")
    part, docs, places = part[order], docs[order], places[order].astype(np.int32)
    first = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    cuts = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
    return pa.table(
        {
            "part": pa.array(part[first[:-1]], pa.int32()),
            "docs": pa.array([docs[a:z].tobytes() for a, z in cuts], pa.binary()),
            "places": pa.array([places[a:z].tobytes() for a, z in cuts], pa.binary()),
        }
    )


def _by_document(table: pa.Table) -> pa.Table:
    ids, parts = per_document(from_bytes(table["docs"], np.int64), from_bytes(table["places"], np.int32))
    return pa.table({"id": pa.array(ids, pa.int64()), "places": pa.array(parts, pa.binary())})


def _hits(key: tuple, table: pa.Table, buckets: int) -> pa.Table:
    """The blocks of one bucket whose words occur at another place as well."""
    docs, places = from_bytes(table["docs"], np.int64), from_bytes(table["places"], np.int32)
    if key[0].as_py() < 0:
        return _parted(docs, places, buckets)
    probes = np.sort(_unpacked(table["probes"]))
    again = probes[1:][probes[1:] == probes[:-1]]
    repeated = np.union1d(again, _unpacked(table["many"]))
    hit = np.isin(_unpacked(table["keys"]), repeated)
    return _parted(docs[hit], places[hit], buckets)


def _extend(
    batches: Iterator[pa.RecordBatch], window: int, block: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Per slab: the first occurrence of each window all of whose blocks were hit."""
    for slab, hits in slabs(batches, extra="hits"):
        size = len(slab.hashes) - window + 1
        if size < 1:
            continue
        # hit[i]: word i starts a block that was hit.
        hit = np.zeros(len(slab.hashes) + window, bool)
        for start, length, parts in zip(slab.starts, slab.lens, hits, strict=True):
            at = np.frombuffer(parts, np.int32).astype(np.int64)
            hit[start + at[at < length]] = True
        place = slab.place()[:size]
        left = np.repeat(slab.lens, slab.lens)[:size] - place
        rest = -place % block
        index = np.arange(size)
        whole = hit[index + rest] & ((rest > 0) | hit[index + block])
        at = np.flatnonzero(whole & (left >= window))
        keys = rolling(slab.hashes, window)[at]
        more = rolling(slab.hashes[::-1], window)[::-1][at].astype(np.uint16)
        docs, places = np.repeat(slab.ids, slab.lens)[at], place[at].astype(np.int32)
        order = np.lexsort((more, keys))  # stable: the earliest of equal windows comes first
        keys, more, docs, places = keys[order], more[order], docs[order], places[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (more[1:] != more[:-1])) if len(keys) else np.empty(0, bool)
        which = np.cumsum(new) - 1
        again = ~new & ~((docs == docs[new][which]) & (places == places[new][which])) if len(keys) else new
        for part in _decided(docs[again], places[again], buckets):
            yield part.select(["bucket", "keys", "probes", "docs", "places"]).rename_columns(
                ["bucket", "keys", "more", "docs", "places"]
            )
        keys, more, docs, places = keys[new], more[new], docs[new], places[new]
        border = cut(keys, buckets)
        rows = []
        for b in range(buckets):
            if border[b] == border[b + 1]:
                continue
            part = slice(border[b], border[b + 1])
            by_place = np.lexsort((places[part], docs[part]))
            rows.append((b, *(x[part][by_place].tobytes() for x in (keys, more, docs, places))))
        yield _batch(rows, _WINDOWS)


def _later(key: tuple, table: pa.Table, buckets: int) -> pa.Table:
    """The windows of one bucket that are not the earliest with their words."""
    docs, places = from_bytes(table["docs"], np.int64), from_bytes(table["places"], np.int32)
    if key[0].as_py() < 0:
        return _parted(docs, places, buckets)
    keys, more = from_bytes(table["keys"], np.uint64), from_bytes(table["more"], np.uint16)
    order = np.lexsort((places, docs, more, keys))
    keys, more, docs, places = keys[order], more[order], docs[order], places[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (more[1:] != more[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    again = ~((docs == docs[first]) & (places == places[first]))
    return _parted(docs[again], places[again], buckets)


def _removed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for piece, values in texts(batches):
        starts = piece.column(piece.schema.get_field_index("starts")).to_pylist()
        nulls = piece.column(piece.schema.get_field_index("text")).is_null().to_pylist()
        kept, counts, removed, digests = [], [], [], []
        for value, parts, null in zip(values, starts, nulls, strict=True):
            words = value.split()
            gone = np.zeros(len(words), bool)
            if parts:
                at = np.frombuffer(parts, np.int32)
                at = at[at + window <= len(words)]
                depth = np.zeros(len(words) + 1, np.int32)
                np.add.at(depth, at, 1)
                np.add.at(depth, at + window, -1)
                gone = np.cumsum(depth[:-1]) > 0
            joined = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
            n = int(gone.sum())
            kept.append(None if null else (joined if n else value).decode())
            counts.append(len(words))
            removed.append(n)
            digests.append(hashlib.sha256(joined).hexdigest())
        columns = {name: piece.column(piece.schema.get_field_index(name)) for name in ("row", "text")} | {
            "kept_text": pa.array(kept, pa.string()),
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        yield pa.RecordBatch.from_pydict(columns)
