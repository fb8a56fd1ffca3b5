"""Language identification in two steps: the family first, then the languages inside it.

A text is a vector of hashed byte 1- to 3-grams of its lower-case form. A linear softmax tells the
family; inside a family, one-versus-one linear support vector machines separate each pair of languages,
and the language with most wins (ties: the larger sum of pair probabilities, then the smaller name) is
the answer. The machines' margins are turned into probabilities by a logistic curve fitted on rows they
were not trained on.

Only the fitting sees a sample: up to about ``SAMPLE`` rows a language and ``SAMPLE_ALL`` in all, chosen by a
hash of the id.
Prediction reads every whole text, a batch at a time, and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.slabs import texts

UNKNOWN = "und"
SAMPLE = 600
# Labelled rows of all languages together, about; each has its numbers, 20 kB, on the driver.
SAMPLE_ALL = 6000
SHORT, LONG = 1024, 4096
DIMENSIONS = SHORT + LONG
# Bytes whose n-grams are counted at once.
CHUNK = 1 << 18

# Language families by ISO 639-1 code. A language that is not listed is a family of its own.
FAMILIES: Mapping[str, str] = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
    "no": "germanic", "nb": "germanic", "nn": "germanic", "is": "germanic", "af": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "ca": "romance", "gl": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic",
    "bg": "slavic", "sr": "slavic", "hr": "slavic", "sl": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic",
}

# ASCII letters stay, other ASCII is blank, bytes of other characters stay.
_TABLE = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def features(values: list[bytes]) -> np.ndarray:
    """One row of unit length per text: square roots of the shares of hashed 1- to 3-grams."""
    padded = [b" " + value.decode().lower().encode().translate(_TABLE) + b"  " for value in values]
    data = np.frombuffer(b"".join(padded) + b"  ", np.uint8)
    lens = np.array(list(map(len, padded)), np.int64)
    ends = np.cumsum(lens)
    counts = np.zeros(len(values) * DIMENSIONS, np.float32)
    for low in range(0, int(ends[-1]) if len(ends) else 0, CHUNK):
        high = min(low + CHUNK, int(ends[-1]))
        inside = np.clip(np.minimum(ends, high) - np.maximum(ends - lens, low), 0, None)
        row = np.repeat(np.arange(len(lens)) * DIMENSIONS, inside)
        first, second, third = (data[low + k : high + k].astype(np.uint32) for k in range(3))
        pair = (first * np.uint32(0x9E3779B1)) ^ (second * np.uint32(0x85EBCA6B))
        triple = (pair ^ (third * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F)
        for key in (
            (pair * np.uint32(0x165667B1)) >> np.uint32(22),
            (first * np.uint32(0x9E3779B1)) >> np.uint32(22),
            SHORT + (triple >> np.uint32(20)),
        ):
            lowest = int(row[0]) if len(row) else 0
            found = np.bincount(row - lowest + key)
            counts[lowest : lowest + len(found)] += found
    rows = np.sqrt(counts.reshape(len(values), DIMENSIONS))
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)


def has_letter(value: bytes) -> bool:
    return any(map(str.isalpha, value.decode()))


@dataclass(frozen=True)
class LanguageModel:
    """``families`` in order with the softmax ``weights``; per family its languages and pair machines."""

    families: list[str]
    weights: np.ndarray
    languages: list[list[str]]
    pairs: list[list[tuple[int, int, np.ndarray, float, float]]]

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and probability of every row."""
        if not self.families:
            return [UNKNOWN] * len(rows), np.zeros(len(rows))
        family = _softmax(_with_bias(rows) @ self.weights)
        best = family.argmax(axis=1)
        names = np.empty(len(rows), object)
        scores = family[np.arange(len(rows)), best].astype(np.float64)
        for f, (languages, pairs) in enumerate(zip(self.languages, self.pairs, strict=True)):
            at = np.flatnonzero(best == f)
            if not len(at):
                continue
            wins, sums = np.zeros((len(at), len(languages))), np.zeros((len(at), len(languages)))
            for a, b, weights, slope, shift in pairs:
                p = 1 / (1 + np.exp(-np.clip(slope * (_with_bias(rows[at]) @ weights) + shift, -30, 30)))
                wins[:, a] += p >= 0.5
                wins[:, b] += p < 0.5
                sums[:, a] += p
                sums[:, b] += 1 - p
            share = sums / max(1, len(languages) - 1)
            winner = (wins + share / 2).argmax(axis=1)
            names[at] = np.array(languages, object)[winner]
            if pairs:
                scores[at] *= share[np.arange(len(at)), winner]
        return names.tolist(), np.clip(scores, 0, 1)


def _with_bias(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, np.ones((len(rows), 1), rows.dtype)], axis=1)


def _softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _descend(gradient, shape: tuple[int, ...], step: float, rounds: int) -> np.ndarray:
    """Nesterov's accelerated descent."""
    at = ahead = np.zeros(shape, np.float32)
    for k in range(rounds):
        before, at = at, ahead - step * gradient(ahead)
        ahead = at + k / (k + 3) * (at - before)
    return at


def fit_softmax(rows: np.ndarray, labels: np.ndarray, classes: int, decay: float = 1e-5) -> np.ndarray:
    x, y = _with_bias(rows), np.eye(classes, dtype=np.float32)[labels]
    weight = (1 / np.bincount(labels, minlength=classes).clip(1))[labels][:, None].astype(np.float32) / classes
    return _descend(lambda w: x.T @ ((_softmax(x @ w) - y) * weight) + decay * w, (x.shape[1], classes), 1.0, 250)


def fit_machine(rows: np.ndarray, sign: np.ndarray, decay: float = 1e-4) -> tuple[np.ndarray, float, float]:
    """A linear support vector machine (squared hinge) and the logistic curve of its margins."""
    held = np.arange(len(rows)) % 4 == 3
    if len(set(sign[held])) < 2 or len(set(sign[~held])) < 2:
        held[:] = False
    x, y = _with_bias(rows), sign.astype(np.float32)
    fitted, truth = x[~held], y[~held]
    weight = np.where(truth > 0, 0.5 / max(1, (truth > 0).sum()), 0.5 / max(1, (truth < 0).sum())).astype(np.float32)

    def gradient(w: np.ndarray) -> np.ndarray:
        slack = np.maximum(0, 1 - truth * (fitted @ w))
        return -2 * (fitted.T @ (weight * truth * slack)) + decay * w

    weights = _descend(gradient, (x.shape[1],), 0.2, 250)
    margin = (x[held] if held.any() else x) @ weights
    target = ((y[held] if held.any() else y) > 0).astype(np.float64)
    slope, shift = 2.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        # A little pull to the start keeps separable margins finite.
        slope -= 2.0 * (((p - target) * margin).mean() + 1e-3 * (slope - 2))
        shift -= 2.0 * ((p - target).mean() + 1e-3 * shift)
    return weights, max(float(slope), 0.1), float(shift)


def fit(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    sample_all: int = SAMPLE_ALL,
    families: Mapping[str, str] = FAMILIES,
) -> LanguageModel:
    """A model of the rows that meet ``training`` and have a language and letters.

    ``sample`` bounds the rows a language in expectation, ``sample_all`` those of all languages; they are
    chosen by a hash of the id. Rows that repeat an id and a text are one.
    """
    rows = docs.filter(training & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    bound = min(float(sample), sample_all / max(1, counts.count()))
    share = counts.select("lang", (F.lit(bound) / F.col("n")).alias("share"))
    id_, lang, text = F.col(id_col).cast("string"), F.col(lang_col), F.col(text_col).cast("string")
    print_ = F.xxhash64(F.lit("langid"), id_, text)
    place = F.pmod(print_, F.lit(1_000_003)) / F.lit(1_000_003.0)
    # Only hashes and languages are joined. What is chosen, a bounded number, is small enough to be sent to
    # the scan of the texts, which are not shuffled; repeated rows are one before they are.
    keys = rows.select(print_.alias("print"), lang.alias("lang"), place.alias("place")).join(share, "lang")
    keys = F.broadcast(keys.filter("place < share").select("print").distinct())
    texts_of = rows.select(print_.alias("print"), lang.alias("lang"), text.alias("text"))
    chosen = texts_of.join(keys, "print", "left_semi").groupBy("print", "lang").agg(F.first("text").alias("text")).select("lang", "text")
    found = chosen.mapInArrow(_featured, "lang string, row binary").collect()
    found = sorted((r.lang, bytes(r.row)) for r in found)
    if not found:
        return LanguageModel([], np.empty((0, 0)), [], [])
    names = np.array([lang for lang, _ in found])
    matrix = np.frombuffer(b"".join(row for _, row in found), np.float32).reshape(len(found), DIMENSIONS)
    order = np.random.default_rng(7).permutation(len(found))
    names, matrix = names[order], matrix[order]
    of = np.array([families.get(name, name) for name in names])
    kinds = sorted(set(of))
    weights = fit_softmax(matrix, np.searchsorted(kinds, of), len(kinds))
    languages, machines = [], []
    for kind in kinds:
        own = sorted(set(names[of == kind]))
        languages.append([str(name) for name in own])
        pairs = []
        for a, b in combinations(range(len(own)), 2):
            at = (names == own[a]) | (names == own[b])
            pairs.append((a, b, *fit_machine(matrix[at], np.where(names[at] == own[a], 1, -1))))
        machines.append(pairs)
    return LanguageModel([str(k) for k in kinds], weights, languages, machines)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` of every row.

    ``lang_pred`` is ``und`` with score 0 if the text is null, has no letters, or nothing was learned.
    Rows without or with repeated ids get results of their own.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _predicted(it, model), rows.select("id").schema.add("lang_pred", "string").add("score", "double"))


def language(text: Column, model: LanguageModel) -> Column:
    """Column ``(lang_pred, score)`` of a text column, as ``identify`` gives them.

    Only the text goes through Python, once, and only the answer comes back; other columns stay in Spark.
    """

    @F.arrow_udf("lang_pred string, score double")
    def of(values: pa.Array) -> pa.Array:
        pieces = texts([pa.RecordBatch.from_arrays([values], ["text"])])
        found = [pa.StructArray.from_arrays(_answers(part, model), ["lang_pred", "score"]) for _, part in pieces]
        kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
        return pa.concat_arrays(found) if found else pa.array([], kind)

    # Spark evaluates it once, also if it is both filtered by and selected.
    return of.asNondeterministic()(text.cast("string"))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, values in texts(batches):
        at = [k for k, value in enumerate(values) if has_letter(value)]
        rows = features([values[k] for k in at])
        langs = piece.column(0).take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays([langs, pa.array([row.tobytes() for row in rows], pa.binary())], ["lang", "row"])


def _answers(values: list[bytes], model: LanguageModel) -> list[pa.Array]:
    names, scores = model.predict(features(values))
    letters = [has_letter(value) for value in values]
    names = [name if ok else UNKNOWN for name, ok in zip(names, letters, strict=True)]
    return [pa.array(names, pa.string()), pa.array(scores * letters, pa.float64())]


def _predicted(batches: Iterator[pa.RecordBatch], model: LanguageModel) -> Iterator[pa.RecordBatch]:
    for piece, values in texts(batches):
        yield pa.RecordBatch.from_arrays([piece.column(0), *_answers(values, model)], ["id", "lang_pred", "score"])
