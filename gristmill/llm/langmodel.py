"""A hashed maximum-entropy language model with a class-factored softmax, under n-grams of all tokens.

A token is a frequent word (the ``WORDS`` most frequent, dealt by rank into ``CLASSES`` classes of equal
size) or belongs to the class *rest*. The class model is

    P(class | context) * P(word | class, context)

The class softmax has hashed features of the context: the token before (n-gram) and the last frequent
token before that, however far back (skip). Inside a frequent class a second softmax has the words'
biases and the skip feature; inside *rest* words follow their smoothed counts, with one share for all
unseen words, so the probabilities of a context add up to one.

The class model is the prior of word n-grams: after a token that occurs c times, a word that follows it n
times has (n + m * P) / (c + m), which adds up to one as well. Every pair of neighbouring tokens counts,
however rare both are. The mass m of a level of c is what makes the training corpus most likely with each
token's own occurrence left out.

Both features of the class model have few values, so the counts of (context, outcome) over the whole
training corpus are a table of bounded size that is sufficient for training: gradient updates run over its
rows on Spark and are exact full-corpus gradients. The tables of tokens and of pairs grow with the corpus:
they are combined per slab, dealt into hash buckets and looked up there, so that no word or pair is a hot
key; the counts go back to the slab that asked. Token counts are exact for every token, pairs are told apart by
48 bits, and nothing but the order of floating-point sums depends on how rows or buckets are dealt to tasks.
Only counts of the ``FREQUENT`` most frequent tokens are sent to the tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.slabs import Slab, bucket_count, cut, edges, from_bytes, mix, slabs
from gristmill.session import Scope

FREQUENT = 65_536
WORDS = 2048
CLASSES = 32
PREVIOUS = 512
SKIPPED = 128
ROUNDS = 8
# Occurrences that the overall shares count for in each feature's own.
PRIOR = 32.0
SMOOTHING = 0.1
# Blocks of the table of context counts.
BLOCKS = 64
# Levels of how often the token before occurs (powers of 8), and the masses that the class model's word may
# have against the counted pairs of a level, times the root of the level's power; last, all of it.
LEVELS = 8
MASSES = (0.25, 1.0, 4.0, 16.0, 64.0, 256.0, np.inf)
# The rows are scored in so many parts, one after the other, as what passes between slabs and buckets is several
# times the text.
PARTS = 4
# Buckets of a partition of a shuffle.
BUCKETS = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)
_END = np.uint64(0xA5A5A5A55A5A5A5A)
_PAIR = np.uint64(0xFFFFFFFFFFFF0000)
_COUNTED = "bucket int, keys binary, counts binary"
_TOTALS = "bucket int, keys binary, counts binary, total long, size long, bins array<int>, sizes array<long>"
_STATE = ("ids", "flags", "lens", "codes", "base", "pairs")
_ASKED = "bucket int, slab long, kind int, keys binary, " + ", ".join(f"{name} binary" for name in _STATE)
_ANSWERED = "slab long, kind int, bucket int, counts binary"
_MIXED = "ids binary, flags binary, tokens binary, known binary, base binary, sums binary, left_out binary"
_SCORED = "id long, train boolean, n_tokens long, n_known long, base_score double, score double"


@dataclass(frozen=True)
class Counts:
    """Token counts of the training rows: the table by bucket, its totals, and its most frequent tokens."""

    table: DataFrame
    tokens: int
    types: int
    keys: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray

    @property
    def frequent(self) -> int:
        """How many words have a softmax of their own."""
        return min(WORDS, len(self.keys))

    def rest_mass(self) -> float:
        """The smoothed count of all words of the class rest, unseen ones excluded."""
        top = int(self.counts[self.ranks < self.frequent].sum())
        return self.tokens - top + SMOOTHING * (self.types - self.frequent)


@dataclass(frozen=True)
class Model:
    """Log10 tables: class scores of both features, their normalizers, and words given the skip feature."""

    previous: np.ndarray
    skipped: np.ndarray
    log_z: np.ndarray
    words: np.ndarray


def tokens_of(slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with an end behind every document, the document of each, and where documents start."""
    n = len(slab.lens)
    found = np.empty(len(slab.hashes) + n, np.uint64)
    found[np.arange(len(slab.hashes)) + slab.doc()] = slab.hashes
    lens = slab.lens + 1
    ends = np.cumsum(lens)
    found[ends - 1] = _END
    return mix(found), np.repeat(np.arange(n), lens), ends - lens


def _log_bin(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(counts) * 16).astype(np.int64)


def rows_of(docs: DataFrame, training: Column, id_col: str, text_col: str) -> DataFrame:
    """``(id, text, of)``: ``id`` is a hash of id and text, so rows without or with repeated ids are told apart."""
    text, own = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    of = F.struct(own.alias("id"), F.coalesce(training, F.lit(False)).alias("train"))
    return docs.select(F.xxhash64(F.coalesce(own, F.lit(-1)), own.isNull(), text).alias("id"), text.alias("text"), of.alias("of"))


def count_tokens(rows: DataFrame, scope: Scope, frequent: int = FREQUENT) -> Counts:
    """Exact counts of the tokens of training rows."""
    buckets = _buckets(rows)
    training = rows.filter("of.train").select("id", "text")
    counted = training.mapInArrow(lambda it: _count(it, buckets), _COUNTED)
    table = scope.stage(counted.groupBy("bucket").applyInArrow(_total, _TOTALS), "token_counts")
    whole = table.agg(F.sum("total"), F.sum("size")).first()
    bins = table.select(F.explode(F.arrays_zip("bins", "sizes")).alias("at")).groupBy("at.bins").agg(F.sum("at.sizes").alias("n"))
    least, kept = 1 << 30, 0
    for level, n in sorted((tuple(r) for r in bins.collect()), reverse=True):
        if kept + n > frequent:
            break
        least, kept = level, kept + n
    top = table.select("keys", "counts").mapInArrow(lambda it: _top(it, least), "key long, n long").collect()
    top = sorted((np.int64(r.key).view(np.uint64), r.n) for r in top)
    keys, counts = np.array([k for k, _ in top], np.uint64), np.array([n for _, n in top], np.int64)
    ranks = np.empty(len(keys), np.int64)
    ranks[np.lexsort((keys, -counts))] = np.arange(len(keys))
    return Counts(table, whole[0] or 0, whole[1] or 0, keys, counts, ranks)


def train(rows: DataFrame, counts: Counts, scope: Scope, rounds: int = ROUNDS) -> Model:
    """Fit both softmaxes by gradient updates over the table of context counts."""
    packed = _lookup(counts)
    contexts = rows.filter("of.train").select("id", "text").mapInArrow(
        lambda it: _contexts(it, packed), "block int, cells binary, counts binary"
    )
    table = scope.stage(contexts.groupBy("block").applyInArrow(_add_cells, "block int, cells binary, counts binary"), "contexts")
    classes = CLASSES + 1
    margins = _gradient(table, None)
    by_previous = margins[: PREVIOUS * classes].reshape(PREVIOUS, classes)
    by_skipped = margins[PREVIOUS * classes : (PREVIOUS + SKIPPED) * classes].reshape(SKIPPED, classes)
    by_word = margins[(PREVIOUS + SKIPPED) * classes : -1].reshape(SKIPPED, WORDS)
    prior = np.log((by_previous.sum(axis=0) + 0.5) / (by_previous.sum() + 0.5 * classes))
    # The start: each feature's own shares, shrunk to the overall ones. A Gaussian prior holds the weights
    # of features that occur rarely near it.
    start = [_shrunk(by_previous, prior, PRIOR), 0.5 * (_shrunk(by_skipped, prior, PRIOR) - prior)]
    mass = [by_previous.sum(axis=1, keepdims=True) + PRIOR, by_skipped.sum(axis=1, keepdims=True) + PRIOR]
    best, at, rate = (-np.inf, start), start, 1.0
    velocity = [np.zeros_like(w) for w in at]
    for _ in range(rounds):
        found = _gradient(table, at)
        if found[-1] < best[0]:
            # A step too far: back to the best point with a smaller one.
            at, rate, velocity = [w.copy() for w in best[1]], rate / 2, [np.zeros_like(w) for w in at]
            found = _gradient(table, at)
        best = (found[-1], [w.copy() for w in at])
        steps = [found[: PREVIOUS * classes].reshape(PREVIOUS, classes), found[PREVIOUS * classes : -1].reshape(SKIPPED, classes)]
        # Each feature's step is its gradient per occurrence.
        steps = [step - PRIOR * (w - w0) for step, w, w0 in zip(steps, at, start, strict=True)]
        velocity = [0.5 * v + rate * step / m for v, step, m in zip(velocity, steps, mass, strict=True)]
        at = [w + v for w, v in zip(at, velocity, strict=True)]
    previous, skipped = best[1]
    log_z = np.stack([_log_sum(previous[a][None, :] + skipped) for a in range(PREVIOUS)])
    overall = np.log((by_word.sum(axis=0) + 0.5) / (by_word.sum() + 0.5 * WORDS))
    words = _words(_shrunk(by_word, overall, 64.0), counts.frequent)
    ten = np.log(10)
    return Model(previous / ten, skipped / ten, log_z / ten, words / ten)


def count_pairs(rows: DataFrame, scope: Scope) -> DataFrame:
    """Counts of every pair of neighbouring tokens of the training rows, by bucket."""
    buckets = _buckets(rows)
    training = rows.filter("of.train").select("id", "text")
    counted = training.mapInArrow(lambda it: _count_pairs(it, buckets), _COUNTED)
    return scope.stage(counted.groupBy("bucket").applyInArrow(_total_pairs, _COUNTED), "pair_counts")


def score(rows: DataFrame, counts: Counts, model: Model, scope: Scope) -> DataFrame:
    """``(id, train, n_tokens, n_known, base_score, score)`` of every row, log10 probabilities of the whole text."""
    buckets = _buckets(rows)
    packed = _lookup(counts)
    by_rank = np.zeros(len(counts.keys), np.int64)
    by_rank[counts.ranks] = counts.counts
    rest = float(np.log10(counts.rest_mass() + SMOOTHING))
    none, frequent, mixed = F.lit(None).cast("binary"), counts.frequent, []
    with Scope(rows.sparkSession) as kept:
        given = counts.table.select("bucket", F.lit(0).alias("kind"), "keys", "counts")
        given = given.unionAll(count_pairs(rows, kept).select("bucket", F.lit(1).alias("kind"), "keys", "counts"))
        given = given.select("bucket", F.lit(None).cast("long").alias("slab"), "kind", "keys", "counts")
        for part in range(PARTS):
            with Scope(rows.sparkSession) as passing:
                # One pass makes both kinds of rows, slabs and what they ask of the buckets; it is written once.
                own = rows.filter(F.pmod("id", F.lit(PARTS)) == part)
                asked = passing.stage(own.mapInArrow(lambda it: _ask(it, packed, model, buckets), _ASKED), "asked")
                both = asked.filter("bucket >= 0").select("bucket", "slab", "kind", "keys", none.alias("counts"))
                answers = passing.stage(both.unionAll(given).groupBy("bucket").applyInArrow(_answer, _ANSWERED), "answers")
                answers = answers.select("slab", "kind", "bucket", "counts", *[none.alias(c) for c in _STATE])
                state = asked.filter("bucket < 0").select("slab", "kind", "bucket", none.alias("counts"), *_STATE)
                found = state.unionAll(answers).groupBy("slab").applyInArrow(lambda t: _mixed(t, by_rank, frequent, rest), _MIXED)
                mixed.append(scope.stage(found, "mixed"))
    mixed = reduce(DataFrame.unionAll, mixed)
    chosen = _chosen(mixed)
    rate = float(np.log10(counts.tokens + SMOOTHING * (counts.types + 1)))
    return mixed.mapInArrow(lambda it: _scored(it, chosen, rate), _SCORED)


def score_texts(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS
) -> tuple[DataFrame, Scope]:
    """Count, train and score: ``(id, train, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    Tokens are runs of non-blank characters with A-Z in lower case, then one end; a null text is empty.
    A row whose ``training`` is null isn't learned from. ``base_score`` is the smoothed unigram model. Rows
    without or with repeated ids get results of their own; without any training row every score is that of
    one unseen word, probability 1.
    """
    scope = Scope(docs.sparkSession)
    rows = rows_of(docs, training, id_col, text_col)
    counts = count_tokens(rows, scope)
    model = train(rows, counts, scope, rounds)
    found = score(rows, counts, model, scope)
    return found.withColumn("train_tokens", F.lit(counts.tokens).cast("long")), scope


# Counting


def _buckets(rows: DataFrame) -> int:
    """The buckets of a table: several a task, as one is held whole; where a token is asked for takes 16 bits."""
    return min(BUCKETS * bucket_count(rows), 1 << 16)


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for slab, _ in slabs(batches, lower=True, whole=True):
        keys, counts = np.unique(tokens_of(slab)[0], return_counts=True)
        at = cut(keys, buckets)
        full = [b for b in range(buckets) if at[b] < at[b + 1]]
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(full, pa.int32()),
                "keys": pa.array([keys[at[b] : at[b + 1]].tobytes() for b in full], pa.binary()),
                "counts": pa.array([counts[at[b] : at[b + 1]].astype(np.int64).tobytes() for b in full], pa.binary()),
            }
        )


def _total(table: pa.Table) -> pa.Table:
    keys, counts = from_bytes(table["keys"], np.uint64), from_bytes(table["counts"], np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    keys, counts = keys[first], np.add.reduceat(counts, first)
    bins, sizes = np.unique(_log_bin(counts), return_counts=True)
    return pa.table(
        {
            "bucket": pa.array([table["bucket"][0].as_py()], pa.int32()),
            "keys": pa.array([keys.tobytes()], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()),
            "total": pa.array([int(counts.sum())], pa.int64()),
            "size": pa.array([len(keys)], pa.int64()),
            "bins": pa.array([bins], pa.list_(pa.int32())),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
        }
    )


def _top(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, counts = from_bytes(batch.column(0), np.uint64), from_bytes(batch.column(1), np.int64)
        at = np.flatnonzero(_log_bin(counts) >= least) if len(counts) else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), pa.array(counts[at])], ["key", "n"])


# Pairs


def _pairs(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each token and the one before; before a document is an end."""
    before = np.append(tokens[-1:], tokens[:-1])
    before[starts] = mix(np.array([_END]))
    return mix(before * _ODD + tokens) & _PAIR


def _narrow(keys: np.ndarray) -> bytes:
    """The 48 bits that tell pairs apart, whatever the number of buckets."""
    return np.ascontiguousarray((keys >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _widened(packed: bytes) -> np.ndarray:
    found = np.zeros((len(packed) // 6, 8), np.uint8)
    found[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return found.view(np.uint64).ravel()


def _keys(values: list, kind: int) -> np.ndarray:
    """The keys of tokens (kind 0) or of pairs (kind 1)."""
    packed = b"".join(value for value in values if value)
    return _widened(packed) if kind else np.frombuffer(packed, np.uint64)


def _counts(values: list, kind: int) -> np.ndarray:
    """The counts of tokens, or of pairs, which are packed."""
    parts = [_unpacked(value) if kind else np.frombuffer(value, np.int64) for value in values if value]
    return np.concatenate([np.empty(0, np.int64), *parts])


def _count_pairs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for slab, _ in slabs(batches, lower=True, whole=True):
        tokens, _, starts = tokens_of(slab)
        keys, counts = np.unique(_pairs(tokens, starts), return_counts=True)
        at = cut(keys, buckets)
        full = [b for b in range(buckets) if at[b] < at[b + 1]]
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(full, pa.int32()),
                "keys": pa.array([_narrow(keys[at[b] : at[b + 1]]) for b in full], pa.binary()),
                "counts": pa.array([_packed(counts[at[b] : at[b + 1]]) for b in full], pa.binary()),
            }
        )


def _total_pairs(table: pa.Table) -> pa.Table:
    keys, counts = _keys(table["keys"].to_pylist(), 1), _counts(table["counts"].to_pylist(), 1)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.add.reduceat(counts, first)
    bucket = pa.array([table["bucket"][0].as_py()], pa.int32())
    packed = _narrow(keys[first] << np.uint64(16))
    return pa.table({"bucket": bucket, "keys": pa.array([packed], pa.binary()), "counts": pa.array([_packed(counts)], pa.binary())})


# Contexts


def _lookup(counts: Counts) -> tuple:
    return counts.keys, counts.ranks, counts.counts, counts.frequent


def _ranked(tokens: np.ndarray, keys: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each token in the frequent table (0 if it isn't there) and its rank (-1)."""
    if not len(keys):
        return np.zeros(len(tokens), np.int64), np.full(len(tokens), -1)
    at = np.minimum(np.searchsorted(keys, tokens), len(keys) - 1)
    return at, np.where(keys[at] == tokens, ranks[at], -1)


def _features(tokens: np.ndarray, rank: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashed token before, and the last frequent token before that one."""
    n = len(tokens)
    own = PREVIOUS * 3 // 4
    hashed = own + (tokens % np.uint64(PREVIOUS - own - 1)).astype(np.int64)
    value = np.where((rank >= 0) & (rank < own), rank, hashed)
    previous = np.append(PREVIOUS - 1, value[:-1])
    previous[starts] = PREVIOUS - 1
    frequent = (rank >= 0) & (rank < SKIPPED - 1)
    last = np.maximum.accumulate(np.where(frequent, np.arange(n), -1))
    before = np.append([-1, -1], last[:-2])[:n]
    start = np.repeat(starts, np.diff(np.append(starts, n)))
    skipped = np.where(before >= start, rank[before], SKIPPED - 1)
    return previous, skipped


def _classes(rank: np.ndarray, frequent: int) -> np.ndarray:
    return np.where((rank >= 0) & (rank < frequent), rank % CLASSES, CLASSES)


def _contexts(batches: Iterator[pa.RecordBatch], packed: tuple) -> Iterator[pa.RecordBatch]:
    """Counts of (previous, skipped, class) and of (skipped, word) of one task, by block of cells."""
    keys, ranks, _, frequent = packed
    classes = CLASSES + 1
    outcomes = PREVIOUS * SKIPPED * classes
    total = np.zeros(outcomes + SKIPPED * WORDS, np.int64)
    for slab, _ in slabs(batches, lower=True, whole=True):
        tokens, _, starts = tokens_of(slab)
        _, rank = _ranked(tokens, keys, ranks)
        previous, skipped = _features(tokens, rank, starts)
        cell = (previous * SKIPPED + skipped) * classes + _classes(rank, frequent)
        total += np.bincount(cell, minlength=len(total))
        known = (rank >= 0) & (rank < frequent)
        total += np.bincount(outcomes + skipped[known] * WORDS + rank[known], minlength=len(total))
    cells = np.flatnonzero(total)
    block = np.searchsorted(cells, np.arange(BLOCKS + 1) * -(-len(total) // BLOCKS))
    full = [b for b in range(BLOCKS) if block[b] < block[b + 1]]
    parts = [cells[block[b] : block[b + 1]] for b in full]
    yield pa.RecordBatch.from_pydict(
        {
            "block": pa.array(full, pa.int32()),
            "cells": pa.array([c.astype(np.int32).tobytes() for c in parts], pa.binary()),
            "counts": pa.array([total[c].tobytes() for c in parts], pa.binary()),
        }
    )


def _add_cells(table: pa.Table) -> pa.Table:
    cells, counts = from_bytes(table["cells"], np.int32), from_bytes(table["counts"], np.int64)
    found, at = np.unique(cells, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, at, counts)
    block = pa.array([table["block"][0].as_py()], pa.int32())
    return pa.table(
        {"block": block, "cells": pa.array([found.tobytes()], pa.binary()), "counts": pa.array([total.tobytes()], pa.binary())}
    )


# Training


def _shrunk(counts: np.ndarray, prior: np.ndarray, weight: float) -> np.ndarray:
    """Log shares of each row, drawn to the overall shares."""
    shares = np.exp(prior)
    return np.log((counts + weight * shares) / (counts.sum(axis=1, keepdims=True) + weight))


def _log_sum(scores: np.ndarray) -> np.ndarray:
    top = scores.max(axis=-1)
    return top + np.log(np.exp(scores - top[..., None]).sum(axis=-1))


def _words(scores: np.ndarray, frequent: int) -> np.ndarray:
    """Log probabilities of each frequent word inside its class, by skip feature."""
    found = np.zeros_like(scores)
    for c in range(CLASSES):
        own = np.arange(c, frequent, CLASSES)
        if len(own):
            found[:, own] = scores[:, own] - _log_sum(scores[:, own])[:, None]
    return found


def _gradient(table: DataFrame, weights: list[np.ndarray] | None) -> np.ndarray:
    """The gradient of the log likelihood and, last, the likelihood; without weights the feature counts."""
    found = table.select("cells", "counts").mapInArrow(lambda it: _task_gradient(it, weights), "places binary, sums binary")
    size = (PREVIOUS + SKIPPED) * (CLASSES + 1) + (SKIPPED * WORDS if weights is None else 0) + 1
    total = np.zeros(size)
    for row in found.collect():
        total[np.frombuffer(row.places, np.int32)] += np.frombuffer(row.sums, np.float64)
    return total


def _task_gradient(batches: Iterator[pa.RecordBatch], weights: list[np.ndarray] | None) -> Iterator[pa.RecordBatch]:
    classes = CLASSES + 1
    outcomes = PREVIOUS * SKIPPED * classes
    previous, skipped = np.zeros((PREVIOUS, classes)), np.zeros((SKIPPED, classes))
    words = np.zeros(SKIPPED * WORDS)
    likelihood, seen = 0.0, False
    for batch in batches:
        cells, counts = from_bytes(batch.column(0), np.int32).astype(np.int64), from_bytes(batch.column(1), np.int64)
        seen |= len(cells) > 0
        word = cells >= outcomes
        words += np.bincount(cells[word] - outcomes, counts[word], minlength=len(words))
        context, outcome = np.divmod(cells[~word], classes)
        weight = counts[~word].astype(np.float64)
        a, b = np.divmod(context, SKIPPED)
        previous += np.bincount(a * classes + outcome, weight, minlength=previous.size).reshape(previous.shape)
        skipped += np.bincount(b * classes + outcome, weight, minlength=skipped.size).reshape(skipped.shape)
        if weights is not None and len(context):
            used, at = np.unique(context, return_inverse=True)
            mass = np.bincount(at, weight)
            ua, ub = np.divmod(used, SKIPPED)
            scores = weights[0][ua] + weights[1][ub]
            log_z = _log_sum(scores)
            expected = np.exp(scores - log_z[:, None]) * mass[:, None]
            np.subtract.at(previous, ua, expected)
            np.subtract.at(skipped, ub, expected)
            likelihood += float((weight * (scores[at, outcome] - log_z[at])).sum())
    if seen:
        parts = [previous.ravel(), skipped.ravel(), *([words] if weights is None else []), [likelihood]]
        whole = np.concatenate(parts)
        at = np.flatnonzero(whole).astype(np.int32)
        yield pa.RecordBatch.from_pydict(
            {"places": pa.array([at.tobytes()], pa.binary()), "sums": pa.array([whole[at].tobytes()], pa.binary())}
        )


# Scoring


def _places(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (np.searchsorted(edges(buckets), keys, side="right") - 1).astype(np.uint16)


def _split(keys: np.ndarray, bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The keys of each bucket, in their order."""
    keys = keys[np.argsort(bucket, kind="stable")]
    border = np.append(0, np.cumsum(np.bincount(bucket, minlength=buckets)))
    for b in range(buckets):
        if border[b] < border[b + 1]:
            yield b, keys[border[b] : border[b + 1]]


def _ask(batches: Iterator[pa.RecordBatch], packed: tuple, model: Model, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per slab: what is known about its tokens, and its rare tokens and its pairs by bucket."""
    keys, ranks, _, frequent = packed
    first = TaskContext.get().partitionId() << 32
    for number, (slab, of) in enumerate(slabs(batches, lower=True, extra="of", whole=True)):
        tokens, _, starts = tokens_of(slab)
        _, rank = _ranked(tokens, keys, ranks)
        previous, skipped = _features(tokens, rank, starts)
        kind = _classes(rank, frequent)
        scores = model.previous[previous, kind] + model.skipped[skipped, kind] - model.log_z[previous, skipped]
        own = kind < CLASSES
        scores[own] += model.words[skipped[own], rank[own]]
        rare = np.flatnonzero(rank < 0)
        where = _places(tokens[rare], buckets)
        codes = rank.astype(np.int32)
        codes[rare] = -1 - where.astype(np.int32)
        pairs = _pairs(tokens, starts)
        met = _places(pairs, buckets)
        rows = [(b, first + number, 0, part.tobytes(), *[None] * 6) for b, part in _split(tokens[rare], where, buckets)]
        rows += [(b, first + number, 1, _narrow(part), *[None] * 6) for b, part in _split(pairs, met, buckets)]
        ids = np.array([o["id"] if o["id"] is not None else 0 for o in of], np.int64)
        flags = np.array([o["train"] + 2 * (o["id"] is None) for o in of], np.int64)
        state = (ids, flags, slab.lens + 1, codes, scores.astype(np.float32), met)
        rows.append((-1, first + number, -1, None, *(x.tobytes() for x in state)))
        kinds = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 7
        columns = zip(*rows, strict=True)
        names = ["bucket", "slab", "kind", "keys", *_STATE]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def _packed(counts: np.ndarray) -> bytes:
    """Counts by byte, lowest bytes first, compressed: most are small."""
    return zlib.compress(np.ascontiguousarray(counts.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _answer(table: pa.Table) -> pa.Table:
    """The counts of all that is asked of one bucket, in the order in which each slab asks."""
    slab, kinds, bucket = table["slab"].to_pylist(), table["kind"].to_pylist(), table["bucket"][0].as_py()
    found: list[tuple] = []
    for kind in (0, 1):
        given = table.filter(pa.array([s is None and k == kind for s, k in zip(slab, kinds, strict=True)]))
        keys, counts = _keys(given["keys"].to_pylist(), kind), _counts(given["counts"].to_pylist(), kind)
        for row, (s, k) in enumerate(zip(slab, kinds, strict=True)):
            if s is not None and k == kind:
                wanted = _keys([table["keys"][row].as_py()], kind)
                answer = np.zeros(len(wanted), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    answer = np.where(keys[at] == wanted, counts[at], 0)
                found.append((s, kind, bucket, _packed(answer)))
    columns = list(zip(*found, strict=True)) or [[]] * 4
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["slab", "kind", "bucket", "counts"])


def _mixed(table: pa.Table, by_rank: np.ndarray, frequent: int, rest_mass: float) -> pa.Table:
    """Per document of a slab: exact counts, and the log probabilities by level under every mass.

    ``left_out`` has the sums over the training documents with each token's own occurrence taken away.
    """
    kinds = table["kind"].to_pylist()
    state = table.filter(pa.array([k < 0 for k in kinds]))
    types = (np.int64, np.int64, np.int64, np.int32, np.float32, np.uint16)
    ids, flags, lens, codes, base, met = (from_bytes(state[name], t) for name, t in zip(_STATE, types, strict=True))
    base = base.astype(np.float64)

    def answered(kind: int) -> np.ndarray:
        own = table.filter(pa.array([k == kind for k in kinds]))
        parts = own.take(np.argsort(own["bucket"].to_numpy(), kind="stable"))["counts"].to_pylist()
        return np.concatenate([np.empty(0, np.int64), *map(_unpacked, parts)])

    rare = np.flatnonzero(codes < 0)
    counts = np.zeros(len(codes), np.int64)
    counts[codes >= 0] = by_rank[codes[codes >= 0]]
    counts[rare[np.argsort((-1 - codes[rare]).astype(np.uint16), kind="stable")]] = answered(0)
    pairs = np.empty(len(codes), np.int64)
    pairs[np.argsort(met, kind="stable")] = answered(1)
    doc = np.repeat(np.arange(len(lens)), lens)
    ends = np.cumsum(lens)
    before = np.append(0, counts[:-1])
    before[ends - lens] = counts[ends - 1]
    rest = (codes < 0) | (codes >= frequent)
    level = np.minimum(np.log2(np.maximum(before, 1)) // 3, LEVELS - 1).astype(np.int64)
    train = (flags & 1).astype(bool)

    def logs(taken: int, of: np.ndarray) -> Iterator[np.ndarray]:
        word = base[of].copy()
        own = np.maximum(counts[of] - taken, 0)[rest[of]]
        word[rest[of]] += np.log10(own + SMOOTHING) - rest_mass
        pair, context = np.maximum(pairs[of] - taken, 0), np.maximum(before[of] - taken, 0)
        share, root = 10**word, 8.0 ** (level[of] / 2)
        for factor in MASSES:
            mass = factor * root
            yield word if np.isinf(factor) else np.log10((pair + mass * share) / (context + mass))

    everything, learned = np.arange(len(codes)), np.flatnonzero(train[doc])
    place = doc * LEVELS + level
    sums = np.stack([np.bincount(place, x, minlength=len(lens) * LEVELS) for x in logs(0, everything)], axis=-1)
    left_out = np.stack([np.bincount(level[learned], x, minlength=LEVELS) for x in logs(1, learned)], axis=-1)
    known = np.bincount(doc, counts > 0, minlength=len(lens)).astype(np.int64)
    exact = np.bincount(doc, np.log10(counts + SMOOTHING), minlength=len(lens))
    columns = (ids, flags, lens, known, exact, sums, left_out)
    names = [field.split()[0] for field in _MIXED.split(", ")]
    return pa.table([pa.array([x.tobytes()], pa.binary()) for x in columns], names=names)


def _chosen(mixed: DataFrame) -> np.ndarray:
    """The mass of each level that makes the training corpus most likely, left-out sums taken."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS * len(MASSES))
        for batch in batches:
            total += from_bytes(batch.column(0), np.float64).reshape(-1, len(total)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["left_out"])

    total = np.zeros(LEVELS * len(MASSES))
    for row in mixed.select("left_out").mapInArrow(added, "left_out binary").collect():
        total += np.frombuffer(row.left_out, np.float64)
    total = total.reshape(LEVELS, len(MASSES))
    return np.where(total.any(axis=1), total.argmax(axis=1), len(MASSES) - 1)


def _scored(batches: Iterator[pa.RecordBatch], chosen: np.ndarray, rate: float) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _SCORED.split(", ")]
    for batch in batches:
        types = (np.int64, np.int64, np.int64, np.int64, np.float64, np.float64)
        ids, flags, lens, known, base, sums = (from_bytes(batch.column(i), t) for i, t in enumerate(types))
        model = sums.reshape(-1, LEVELS, len(MASSES))[:, np.arange(LEVELS), chosen].sum(axis=1)
        arrays = [pa.array(ids, mask=(flags & 2) > 0), pa.array((flags & 1) > 0), pa.array(lens), pa.array(known)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(base - lens * rate), pa.array(model)], names)
