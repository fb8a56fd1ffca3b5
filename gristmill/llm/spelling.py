"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

1. *Words.* Runs of ASCII and Latin-1 letters of whole texts, A-Z in lower case, are counted in each task
   before anything is shuffled. ``damage`` can delete a code point of a run first (the registered query's rule).
2. *Blocks.* One edit leaves the first or the last half of a word as it is. Of two words with ``b`` and ``b``
   or ``b + 1`` letters, either the first ``b // 2`` or the last ``b - b // 2`` code points are equal, so words
   are posted under both halves, for ``b`` their own length and one less: adjacent length blocks only.
   A half that more than ``TILE`` words have is dealt by a hash of the word into tiles of rows and columns;
   every pair of words meets in one tile, and no task holds more than a tile.
3. *Gram matrices.* In a tile the words are rows of letter counts, and one product gives all squared distances:
   an inserted or deleted letter makes 1, a replaced one 2. Pairs at most two apart are verified on their letters.
   A pair that shares both halves is taken under the first one alone, so every near pair is seen exactly once,
   and a tile returns one row per word (how many are near, the most frequent of them) instead of its pairs.
4. *Forms.* A word's form is its most frequent near word if that is ``ratio`` times as frequent; roots follow
   forms by pointer doubling. Counts grow ``ratio``-fold along a chain, so few rounds are needed.

Nothing is capped: a hot half costs more tiles, not a larger one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.slabs import texts
from gristmill.session import Scope

LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
# Words on one side of a product; longer words make smaller tiles.
TILE = 2048
# Distinct words that a task counts before it hands them on.
COUNTED = 400_000
# Bytes of a text that are split into words at once.
PIECE = 1 << 20
# Cells of two verified letter matrices at once.
CELLS = 4_000_000

# Letters stay (A-Z in lower case), other ASCII is blank, bytes of longer sequences stay.
_TABLE = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
# UTF-8 sequences of code points that are not U+00C0 to U+00FF.
_OTHER = re.compile(rb"[\xc2\xc4-\xf4][\x80-\xbf]+")
_DAMAGE = 31


def runs(value: bytes) -> Iterator[list[bytes]]:
    """The letter runs of a text in UTF-8, some at a time."""
    value = value.translate(_TABLE)
    if not value.isascii():
        value = _OTHER.sub(b" ", value)
    start = 0
    while start < len(value):
        end = value.find(b" ", start + PIECE) if len(value) - start > PIECE else len(value)
        end = len(value) if end < 0 else end
        yield value[start:end].split()
        start = end


def shorten(words: list[bytes], id_: str) -> list[bytes]:
    """Deletes a code point of every run whose checksum with the row's id is a multiple of 31."""
    head = zlib.crc32(f"{id_}:".encode())
    found = []
    for word in words:
        h = zlib.crc32(word, head)
        if not h % _DAMAGE:
            letters = word.decode()
            k = h % len(letters)
            word = (letters[:k] + letters[k + 1 :]).encode()
        found.append(word)
    return found


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    damage: Callable[[list[bytes], str], list[bytes]] | None = None,
) -> DataFrame:
    """``(word, n)`` of all words with enough letters and occurrences. A null text has none, a null id is empty."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    counted = rows.filter("text is not null").mapInArrow(lambda it: _counted(it, least_letters, damage), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def variants(words: DataFrame, ratio: int = RATIO, tile: int = TILE) -> tuple[DataFrame, Scope]:
    """``(word, form, root, n, n_near, form_n)`` of distinct ``words (word, n)``, and the owner of staged tables.

    ``words`` are made of code points below U+0100; repeated words are added up, null words are left out.
    ``form`` is the near word of largest ``n`` (ties: smallest in code-point order) if that is at least
    ``ratio * n``, else null; ``root`` is reached by following forms. An empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    scope = Scope(words.sparkSession)
    words = words.filter("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = scope.stage(words, "words")
    near = near_words(words, scope, tile)
    least = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    found = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), least)
    found = words.join(found, "word", "left")
    form_n = -F.col("best.less")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(form_n >= F.col("n") * ratio, F.col("best.form")).alias("form"),
        F.when(form_n >= F.col("n") * ratio, form_n).alias("form_n"),
    )
    found = scope.stage(found, "forms")
    roots = _roots(found.filter("form is not null").select("word", F.col("form").alias("root")), scope)
    found = found.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), scope


def near_words(words: DataFrame, scope: Scope, tile: int = TILE) -> DataFrame:
    """``(word, n_near, form, form_n)`` per word and tile; sums of ``n_near`` count every near word once."""
    posted = words.withColumn("letters", F.char_length("word"))
    posted = posted.withColumn("base", F.explode(F.array("letters", F.col("letters") - 1)))
    half = F.expr("base div 2").cast("int")
    sides = F.array(
        F.struct(F.lit("p").alias("side"), F.substring("word", F.lit(1), half).alias("half")),
        F.struct(F.lit("s").alias("side"), F.right("word", F.col("base") - half).alias("half")),
    )
    posted = posted.select("word", "n", "letters", "base", F.explode(sides).alias("at")).select(
        "word", "n", "base", (F.col("letters") == F.col("base")).alias("row"), "at.side", "at.half"
    )
    key = ["base", "side", "half"]
    blocks = posted.groupBy(*key).agg(F.count(F.lit(1)).alias("size"), F.count_if("row").alias("rows"))
    # A block needs a pair, and a word of the shorter length in it.
    blocks = blocks.filter("size > 1 and rows > 0")
    parts = F.ceil(F.col("size") * F.greatest("base", F.lit(64)) / (64 * tile)).cast("int").alias("parts")
    posted = posted.join(blocks.select(*key, parts), key)
    posted = posted.withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)

    def at(r: Column, c: Column) -> Column:
        return F.struct(r.alias("r"), c.alias("c"))

    # A tile (r, c) has the shorter words of part r as rows, the longer ones of part c as columns, and
    # on and above the diagonal also the shorter ones of part c.
    columns = F.transform(F.sequence(F.lit(0), "part"), lambda r: at(r, F.col("part")))
    places = F.when(F.col("row"), F.array_union(F.transform(every, lambda c: at(F.col("part"), c)), columns))
    places = places.otherwise(F.transform(every, lambda r: at(r, F.col("part"))))
    placed = posted.withColumn("at", F.explode(places))
    tiles = placed.select(
        F.concat_ws(" ", "side", "base", "at.r", "at.c", "half").alias("tile"), "word", "n", "base", "row", "side",
        (F.col("part") == F.col("at.r")).alias("left"), (F.col("part") == F.col("at.c")).alias("right"),
    )
    dealt = tiles.repartition("tile").sortWithinPartitions("tile", "word")
    return dealt.mapInArrow(_near, "word string, n_near long, form string, form_n long")


def _roots(links: DataFrame, scope: Scope) -> DataFrame:
    """``(word, root)``: pointer doubling over ``(word, root)`` links without circles."""
    links = scope.stage(links, "links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(ahead, "root", "left")
        moved = moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = scope.stage(moved, "roots")
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return links


def _counted(
    batches: Iterator[pa.RecordBatch], least_letters: int, damage: Callable[[list[bytes], str], list[bytes]] | None
) -> Iterator[pa.RecordBatch]:
    counter: Counter[bytes] = Counter()

    def made() -> pa.RecordBatch:
        # A letter beyond ASCII has two bytes, the first of them 0xC3.
        kept = [(w, n) for w, n in counter.items() if len(w) - w.count(b"\xc3") >= least_letters]
        words = pa.array([w for w, _ in kept], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    for piece, values in texts(batches):
        ids = piece.column(piece.schema.get_field_index("id")).to_pylist()
        for id_, value in zip(ids, values, strict=True):
            for found in runs(value):
                # What has too few bytes has too few letters, before and after a deletion.
                found = [word for word in found if len(word) >= least_letters]
                counter.update(damage(found, id_) if damage else found)
                if len(counter) >= COUNTED:
                    yield made()
                    counter.clear()
    if counter:
        yield made()


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """Rows of letter counts of words given as rows of Latin-1 codes (zero: no letter); only letters that occur."""
    used = np.flatnonzero(np.bincount(letters.ravel(), minlength=256)[1:]) + 1
    column = np.zeros(256, np.int64)
    column[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    at = np.arange(len(letters))[:, None] * width + column[letters]
    return np.bincount(at.ravel(), minlength=len(letters) * width).reshape(len(letters), width)[:, 1:].astype(np.float32)


def near_pairs(letters: np.ndarray, lens: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes ``(i, j)`` of all pairs of ``rows`` x ``columns`` that are one edit apart.

    Rows have ``b`` letters, columns ``b`` or ``b + 1``.
    """
    counts = letter_counts(letters)
    squares = (counts * counts).sum(axis=1)
    distance = squares[rows][:, None] + squares[columns][None, :] - 2 * (counts[rows] @ counts[columns].T)
    i, j = np.nonzero(distance <= 2.5)
    i, j = rows[i], columns[j]
    good = np.zeros(len(i), bool)
    step = max(1, CELLS // max(1, letters.shape[1]))
    for start in range(0, len(i), step):
        part = slice(start, start + step)
        good[part] = one_edit(letters, lens, i[part], j[part])
    return i[good], j[good]


def one_edit(letters: np.ndarray, lens: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words ``i`` become words ``j`` (as long, or one longer) by one replaced or inserted letter."""
    good = np.zeros(len(i), bool)
    same = lens[i] == lens[j]
    good[same] = (letters[i[same]] != letters[j[same]]).sum(axis=1) == 1
    a, b = i[~same], j[~same]
    if len(a):
        # In a tile all rows have the same length.
        n = int(lens[a[0]])
        shorter, longer = letters[a, :n], letters[b, : n + 1]
        ahead = np.logical_and.accumulate(shorter == longer[:, :n], axis=1).sum(axis=1)
        behind = np.logical_and.accumulate((shorter == longer[:, 1:])[:, ::-1], axis=1).sum(axis=1)
        good[~same] = ahead + behind >= n
    return good


def _best(words: list[str], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[list, list, list, list]:
    """Per word that has near ones: how many, and the one of largest ``n``, the first in order of words."""
    source, target = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort((target, -n[target], source))
    source, target = source[order], target[order]
    first = np.flatnonzero(np.append(True, source[1:] != source[:-1]))
    sizes = np.diff(np.append(first, len(source)))
    return [words[k] for k in source[first]], sizes.tolist(), [words[k] for k in target[first]], n[target[first]].tolist()


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted tiles: one tile at a time."""
    made: tuple[list, list, list, list] = ([], [], [], [])

    def flush() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        arrays = [pa.array(values, kind) for values, kind in zip(made, kinds, strict=True)]
        for values in made:
            values.clear()
        return pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "form", "form_n"])

    for table in _tiles(batches):
        words = table.column("word").to_pylist()
        n, row = table.column("n").to_numpy(), table.column("row").to_numpy()
        left, right = table.column("left").to_numpy(), table.column("right").to_numpy()
        rows = np.flatnonzero(row & left)
        if len(words) < 2 or not len(rows):
            continue
        base, side = table.column("base")[0].as_py(), table.column("side")[0].as_py()
        encoded = [word.encode("latin-1") for word in words]
        letters = np.frombuffer(b"".join(word.ljust(base + 1, b"\0") for word in encoded), np.uint8).reshape(len(words), base + 1)
        # Off the diagonal, shorter words that are rows are not columns.
        columns = np.flatnonzero(right)
        i, j = near_pairs(letters, np.where(row, base, base + 1), rows, columns)
        diagonal = left[i] & right[i] & row[j]
        keep = ~diagonal | (i < j)
        if side == "s":
            half = base // 2
            keep &= (letters[i, :half] != letters[j, :half]).any(axis=1)
        i, j = i[keep], j[keep]
        if len(i):
            for values, more in zip(made, _best(words, n, i, j), strict=True):
                values += more
            if len(made[0]) >= 10_000:
                yield flush()
    if made[0]:
        yield flush()


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The tables of consecutive equal tile names."""
    open_parts: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        names = batch.column(batch.schema.get_field_index("tile")).to_pylist()
        start = 0
        for k, this in enumerate(names):
            if this != name:
                if k > start:
                    open_parts.append(batch.slice(start, k - start))
                if open_parts:
                    yield pa.Table.from_batches(open_parts)
                open_parts, start, name = [], k, this
        open_parts.append(batch.slice(start))
    if open_parts:
        yield pa.Table.from_batches(open_parts)
