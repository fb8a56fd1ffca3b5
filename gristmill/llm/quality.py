"""Document quality: random-indexing word vectors, pooled, then a two-layer network with calibrated output.

Random indexing (Kanerva et al. 2000): every token has a fixed sparse vector of +1 and -1 drawn by its
hash; its *word vector* is the sum of the fixed vectors of the tokens around it in the whole corpus.
Words and their shapes (what kind of character they begin and end with) are hashed to a bounded number
of rows, so the table is of one size for any corpus; each task adds up its own and the sums meet by block.

A document is the mean vector of its words, of its distinct words and of its shapes, and its length. The
network is trained in numpy on a sample of labelled rows (``SAMPLE`` in expectation, chosen by a hash of
the id), and its temperature is set on rows it has not seen. Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.slabs import REMEMBERED_WORDS, texts

SAMPLE = 20_000
WORD_ROWS, SHAPE_ROWS = 16_384, 1024
ROWS = WORD_ROWS + SHAPE_ROWS
DIMENSIONS = 32
NONZERO = 2
REACH = 2
HIDDEN = 32
BLOCK = 1024
# Words whose vectors are held at once.
CHUNK_WORDS = 200_000
INPUTS = 3 * DIMENSIONS + 2

# Shapes: A for upper case, a for lower case and bytes of other letters, 0 for digits, others themselves.
_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))


class _TokenRows(dict):
    """Word row and shape row of a word, packed in one number and remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        shape = (word[:1] + word[-2:]).translate(_SHAPE)
        row = xxhash.xxh3_64_intdigest(word) % WORD_ROWS
        value = self[word] = row << 16 | xxhash.xxh3_64_intdigest(shape) % SHAPE_ROWS
        return value


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of the batches with the words per document, and the word and shape rows of all words."""
    known = _TokenRows()
    for piece, values in texts(batches):
        split = [value.split() for value in values]
        lens = np.array(list(map(len, split)), np.int64)
        words = [w for own in split for w in own]
        both = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        yield piece, lens, both >> 16, WORD_ROWS + (both & 0xFFFF)


def fixed_vectors() -> tuple[np.ndarray, np.ndarray]:
    """The places and signs of the nonzero parts of every row's fixed vector."""
    draw = np.random.default_rng(20240229)
    places = np.stack([draw.permutation(DIMENSIONS)[:NONZERO] for _ in range(ROWS)])
    return places, draw.choice([-1, 1], (ROWS, NONZERO))


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """One unit vector per row of the table, from all of ``docs``."""
    summed = (
        docs.select(F.col(text_col).cast("string").alias("text"))
        .mapInArrow(_contexts, "block int, sums binary")
        .groupBy("block")
        .applyInArrow(_added, "block int, sums binary")
    )
    total = np.zeros((ROWS // BLOCK, BLOCK * DIMENSIONS))
    for row in summed.collect():  # ROWS / BLOCK rows, whatever the corpus
        total[row.block] = np.frombuffer(row.sums, np.int64)
    vectors = total.reshape(ROWS, DIMENSIONS)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norms > 0, norms, 1)).astype(np.float32)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = fixed_vectors()
    total = np.zeros(ROWS * DIMENSIONS, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add() -> None:
        lens, words, shapes = (np.concatenate(parts) for parts in zip(*waiting, strict=True))
        doc = np.repeat(np.arange(len(lens)), lens)
        for reach in range(1, REACH + 1):
            near = np.flatnonzero(doc[reach:] == doc[:-reach])
            for here, there in ((near, near + reach), (near + reach, near)):
                for rows, others in ((words, words), (words, shapes), (shapes, shapes)):
                    own, of = rows[here] * DIMENSIONS, others[there]
                    for k in range(NONZERO):
                        # Sums of +1 and -1 are whole numbers, which doubles hold exactly.
                        total[:] += np.bincount(own + places[of, k], signs[of, k], len(total)).astype(np.int64)

    for _, *arrays in _pieces(batches):
        waiting.append(tuple(arrays))
        if sum(len(words) for _, words, _ in waiting) >= 4 * CHUNK_WORDS:
            add()
            waiting = []
    if waiting:
        add()
    blocks = total.reshape(ROWS // BLOCK, -1)
    yield pa.RecordBatch.from_pydict(
        {"block": pa.array(range(len(blocks)), pa.int32()), "sums": pa.array([b.tobytes() for b in blocks], pa.binary())}
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, block = np.zeros(BLOCK * DIMENSIONS, np.int64), 0
    for batch in batches:
        block = batch.column(0)[0].as_py()
        for value in batch.column(1):
            total += np.frombuffer(value.as_py(), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "sums"])


def _pooled(lens: np.ndarray, words: np.ndarray, shapes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The inputs of the network, one row per document; a document without words is all zeros."""
    found = np.zeros((len(lens), INPUTS), np.float32)
    ends = np.cumsum(lens)
    groups = np.split(np.arange(len(lens)), np.flatnonzero(np.diff(ends // CHUNK_WORDS)) + 1)
    for group in groups:
        group = group[lens[group] > 0]
        if not len(group):
            continue
        begin, end = ends[group[0]] - lens[group[0]], ends[group[-1]]
        own_lens = lens[group]
        starts = np.cumsum(own_lens) - own_lens
        own, shape = words[begin:end], shapes[begin:end]
        doc = np.repeat(np.arange(len(group)), own_lens)
        distinct = np.unique(doc * ROWS + own)
        distinct_doc, distinct_row = np.divmod(distinct, ROWS)
        distinct_lens = np.bincount(distinct_doc, minlength=len(group))
        distinct_starts = np.cumsum(distinct_lens) - distinct_lens
        found[group] = np.concatenate(
            [
                np.add.reduceat(vectors[own], starts) / own_lens[:, None],
                np.add.reduceat(vectors[distinct_row], distinct_starts) / distinct_lens[:, None],
                np.add.reduceat(vectors[shape], starts) / own_lens[:, None],
                np.log1p(own_lens)[:, None],
                (distinct_lens / own_lens)[:, None],
            ],
            axis=1,
        )
    return found


@dataclass(frozen=True)
class Network:
    """Inputs are centred and scaled, then two layers; ``temperature`` divides the last score."""

    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        hidden = np.tanh((rows - self.centre) / self.scale @ w1 + b1)
        return 1 / (1 + np.exp(-np.clip((hidden @ w2 + b2) / self.temperature, -40, 40)))


def fit_network(rows: np.ndarray, labels: np.ndarray, rounds: int = 60, seed: int = 11) -> Network:
    """Adam on four fifths of the rows; the temperature that makes the rest likeliest.

    Without rows of both labels every score is their share (one half without any).
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    flat = np.zeros((INPUTS, HIDDEN), np.float32)
    if len(set(labels.tolist())) < 2:
        bias = np.float32(np.log(share / (1 - share)))
        return Network(np.zeros(INPUTS, np.float32), np.ones(INPUTS, np.float32), [flat, flat[0], flat[0], bias], 1.0)
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(rows))
    rows, labels = rows[order], labels[order].astype(np.float32)
    held = np.arange(len(rows)) % 5 == 4
    centre, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    x, y = ((rows - centre) / scale)[~held], labels[~held]
    layers = [
        draw.normal(0, INPUTS**-0.5, (INPUTS, HIDDEN)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        draw.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32),
        np.float32(np.log(share / (1 - share))),
    ]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(rounds):
        order = draw.permutation(len(x))
        for at in np.split(order, range(256, len(order), 256)):
            w1, b1, w2, b2 = layers
            hidden = np.tanh(x[at] @ w1 + b1)
            error = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -40, 40))) - y[at]) / len(at)
            back = error[:, None] * w2 * (1 - hidden**2)
            slopes = [x[at].T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ error + 1e-4 * w2, error.sum()]
            step += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                rate = 0.003 / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                layers[k] = (layers[k] - rate * first[k]).astype(np.float32)
    plain = Network(centre, scale, layers, 1.0)
    p = np.clip(plain.scores(rows[held]), 1e-9, 1 - 1e-9)
    logit, target = np.log(p / (1 - p)), labels[held]
    candidates = np.geomspace(0.25, 8, 61)
    losses = [np.logaddexp(0, np.where(target > 0, -1, 1) * logit / t).mean() for t in candidates]
    return Network(centre, scale, layers, float(candidates[int(np.argmin(losses))]) if held.any() else 1.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    vectors: np.ndarray,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Network:
    """A network of the labelled rows that meet ``training`` (of their id).

    Rows of labels that share an id count once, with the label that most of them have (ties: 1); null
    labels and ids are left out.
    """
    given = labels.filter(training & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    given = given.groupBy(F.col(id_col).alias("id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    share = sample / max(1, given.count())
    place = F.pmod(F.xxhash64(F.lit("quality"), F.col("id").cast("string")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    # About ``sample`` rows, whatever the tables: small enough to be sent to every task.
    chosen = F.broadcast(given.filter(place < F.lit(share)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(chosen, "id")
    pooled = rows.select("id", "text", "label").mapInArrow(lambda it: _sampled(it, vectors), "id long, label int, row binary")
    found = sorted((r.id, r.label, bytes(r.row)) for r in pooled.collect())
    matrix = np.frombuffer(b"".join(row for _, _, row in found), np.float32).reshape(len(found), INPUTS)
    return fit_network(matrix, np.array([label for _, label, _ in found], np.int64))


def _sampled(batches: Iterator[pa.RecordBatch], vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
    for piece, lens, words, shapes in _pieces(batches):
        rows = _pooled(lens, words, shapes, vectors)
        packed = pa.array([row.tobytes() for row in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([piece.column(0).cast(pa.int64()), piece.column(2), packed], ["id", "label", "row"])


def score(
    docs: DataFrame, vectors: np.ndarray, network: Network, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, score)`` of every row; a null text is empty, and an empty one has a score like any other."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, lens, words, shapes in _pieces(batches):
            found = network.scores(_pooled(lens, words, shapes, vectors)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found)], ["id", "score"])

    return rows.mapInArrow(scored, f"id {kind}, score double")
