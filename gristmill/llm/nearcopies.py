"""MinHash near-dedup by an inverted join on signature coordinates.

1. Each document's set of word shingles gets a signature of ``K`` coordinates, the minima of ``K``
   hash functions. Documents with equal sets (fingerprint of 128 bits) form one *class*; only its
   smallest id goes on, so a text copied a million times is one row.
2. Classes are posted under each (coordinate, value) pair. A similar pair agrees in at least
   ``matches`` coordinates but for a chance of ``LOSS``. Values that only one class has can't collide
   and are left out, and a class with fewer than ``matches`` shared values is done.
3. Skipping: of its ``s`` shared values a class only needs the ``s - matches + 1`` rarest (the prefix);
   two classes with ``matches`` common values share one of those, so the longest lists are never merged.
4. Lists are merged around leaders instead of into pairs, in rounds. A list names a leader in its largest
   component (ties and members by a hash, another one in each round), and each class meets a single leader:
   the one with the least hash of all its lists name. So neighbourhoods that share many lists gather around
   few leaders, and a round has at most one pair per class, however large a family of near copies is. Pairs
   with enough equal coordinates are confirmed on the full sets and become links, components grow, and a list
   whose members are all in one component is finished. Rounds go on while they pay.
5. What is still open goes on with the shingles themselves as values: the same prefix rule, now exact.
   Only shingles that occur in several open components count; a class with too few of them for the
   smallest member of its lists can have no partner and leaves, the others are posted under their rarest.
   Here a leader, the member of a component with most shared values, meets the members of all other components
   in its list and leaves it, ``GROWTH`` times as many leaders in each round (beyond ``ALONE`` several of one
   component), until no list is open: nothing is capped, and no pair across components is left unseen. Sets carry
   a sketch, the parities of their shingles in ``BITS`` bins: bins that differ are shingles that only one of two
   sets has, so a meeting whose sketches differ in too many bins is no link and goes no further.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.llm.components import components, stars
from gristmill.llm.slabs import identified, mix, rolling, slabs
from gristmill.session import Scope

SHINGLE = 5
PERCENT = 80
K = 64
# The chance that a pair exactly at the threshold agrees in fewer coordinates than are asked for.
LOSS = 1e-6
# How many times as many leaders a list may have in each further round.
GROWTH = 16
# Up to that many leaders each is of another component; then components may name several, so that two large
# ones in a list take a few rounds more and not one per member.
ALONE = 256
# Rounds of one leader per class go on while this share of their pairs are links.
PAYS = 0.25
# Bins of a sketch, 64 to a number.
BITS = 512
# Words that are hashed at once; a worker keeps no word beyond that.
HASHED_WORDS = 1 << 18
_SIGNED = "id long, n long, f1 long, f2 long, signature array<int>"


def least_matches(k: int, similarity: float, loss: float = LOSS) -> int:
    """The largest number of coordinates that a pair at ``similarity`` misses with a chance up to ``loss``."""
    below = 0.0
    for t in range(k + 1):
        below += math.comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if below > loss:
            return max(1, t)
    return k


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    k: int = K,
) -> tuple[DataFrame, Scope]:
    """``(id, n_shingles, component_id, kept)`` per row with an id, and the owner of the staged tables.

    Words are runs of non-blank characters with A-Z in lower case. Documents are linked if
    ``100 * intersection >= percent * union`` of their shingle sets; a document with fewer words than a
    shingle has its whole sequence as the only one. A null or blank text has an empty set and no link,
    so it is kept as a component of its own. ``component_id`` is the smallest id that is reachable.
    Rows that share an id are one document whose links are those of all of them; each keeps its own count.
    """
    scope = Scope(docs.sparkSession)
    rows = identified(docs, id_col, text_col)
    matches = least_matches(k, percent / 100)
    signed = scope.stage(rows.mapInArrow(lambda it: _sign(it, shingle, k), _SIGNED), "signatures")
    key = ["f1", "f2", "n"]
    classes = signed.filter("n > 0").groupBy(*key).agg(F.min("id").alias("rep"), F.first("signature").alias("signature"))
    classes = scope.stage(classes, "classes")
    lists = scope.stage(prefix_lists(classes, matches), "lists")
    labels = _merge(rows, classes, lists, scope, shingle, percent, matches)
    placed = signed.select("id", *key).join(classes.select(*key, "rep"), key, "left").join(labels, "rep", "left")
    own = F.coalesce("component", "rep", "id")
    # Rows that share an id connect their classes: the label of an id is settled once more.
    twice = placed.groupBy("id").agg(F.min(own).alias("low"), F.max(own).alias("high"))
    joined = scope.stage(twice.filter("low < high").select(F.col("low").alias("i"), F.col("high").alias("j")), "joined")
    if not joined.isEmpty():
        further = components(joined, scope).select(F.col("id").alias("component"), F.col("component").alias("final"))
        placed = placed.withColumn("component", own).join(further, "component", "left")
        own = F.coalesce("final", "component")
    found = placed.select("id", F.col("n").alias("n_shingles"), own.alias("component_id"))
    return found.withColumn("kept", F.col("id") == F.col("component_id")), scope


def prefix_lists(classes: DataFrame, matches: int) -> DataFrame:
    """``(token, rep, n, shared)``: classes under the rarest of the values they share with others."""
    token = F.shiftleft(F.col("coordinate").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND((1 << 32) - 1))
    posted = classes.select("rep", "n", F.posexplode("signature").alias("coordinate", "value"))
    posted = posted.select("rep", "n", token.alias("token"))
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    values = posted.join(shared, "token").groupBy("rep", "n").agg(F.collect_list(F.struct("length", "token")).alias("of"))
    values = values.withColumn("shared", F.size("of")).filter(F.col("shared") >= matches)
    prefix = F.slice(F.sort_array("of"), F.lit(1), F.col("shared") - (matches - 1))
    return values.select("rep", "n", "shared", F.explode(prefix).alias("at")).select("at.token", "rep", "n", "shared")


def _merge(
    rows: DataFrame, classes: DataFrame, lists: DataFrame, scope: Scope, shingle: int, percent: int, matches: int
) -> DataFrame:
    """``(rep, component)`` of every class in a list, by rounds around leaders until no list is open."""
    labels = lists.select("rep", F.col("rep").alias("component")).distinct()
    posted = _open(lists.withColumn("component", F.col("rep")), scope)
    if posted.isEmpty():
        return labels
    active = posted.select("rep").distinct()
    # Seven bits of each coordinate: pairs agree by chance in half a coordinate more, none is lost.
    short = F.transform("signature", lambda x: x.bitwiseAND(127).cast("tinyint")).alias("signature")
    signatures = scope.stage(classes.join(active, "rep", "left_semi").select("rep", short), "active")
    sets = scope.stage(_sets_of(rows, classes, signatures.select("rep"), shingle), "sets")
    tested: DataFrame | None = None

    def settle(pairs: DataFrame, left: DataFrame) -> tuple[DataFrame, bool]:
        """The lists that stay open of ``left`` after the new ones of the pairs are confirmed, and whether that paid."""
        nonlocal tested, labels
        if tested is not None:
            pairs = pairs.join(tested, ["i", "j"], "left_anti")
        pairs = scope.stage(pairs, "pairs")
        tested = pairs if tested is None else tested.unionAll(pairs)
        links = scope.stage(_confirmed(pairs, sets, percent), "confirmed")
        many = links.count()
        if many:
            named = links.join(labels.toDF("i", "ci"), "i").join(labels.toDF("j", "cj"), "j")
            merged = stars(named.select(F.col("ci").alias("i"), F.col("cj").alias("j")), scope).toDF("component", "to")
            labels = scope.stage(_relabelled(labels, merged).select("rep", "component"), "labels")
            left = _relabelled(left, merged).select(*left.columns)
        return _open(left, scope), many > PAYS * pairs.count()

    turn, pays = 0, True
    while pays and not posted.isEmpty():
        posted, pays = settle(_matching(_nearest_leader(posted, turn, percent), signatures, matches), posted)
        turn += 1
    posted = _open(_exact_lists(posted, sets, percent), scope)
    limit = 1
    while not posted.isEmpty():
        leaders = scope.stage(_leaders(posted, limit, max(1, limit // ALONE)), "leaders")
        left = posted.join(leaders.select("token", "rep"), ["token", "rep"], "left_anti")
        posted, _ = settle(_across(leaders, posted, percent), left)
        limit *= GROWTH
    return labels


def _nearest_leader(posted: DataFrame, turn: int, percent: int) -> DataFrame:
    """``(i, j)``: each class with one of the leaders that its lists name, if its own component has not that leader.

    A list's leader is in the component that most of its members are in, so that a large component is met by
    those outside of it and not the other way round.
    """
    draw = F.xxhash64(F.lit(turn), "rep")
    of = posted.groupBy("token", "component").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(draw.alias("draw"), "rep", "n")).alias("at"))
    named = of.groupBy("token").agg(F.max(F.struct("size", (-F.xxhash64(F.lit(turn), "component")).alias("draw"), "component", "at")).alias("best"))
    leaders = named.select(
        "token", F.col("best.at.draw").alias("draw"), F.col("best.at.rep").alias("a"), F.col("best.at.n").alias("an"), F.col("best.component").alias("ac")
    )
    met = posted.select("token", "rep", "n", "component").join(leaders, "token").filter("component != ac")
    met = met.filter(F.least("an", "n") * 100 >= F.greatest("an", "n") * percent)
    one = met.groupBy("rep").agg(F.min(F.struct("draw", "a")).alias("one"))
    # Two that are each other's leader are one pair.
    return one.select(F.least("rep", "one.a").alias("i"), F.greatest("rep", "one.a").alias("j")).distinct()


def _open(posted: DataFrame, scope: Scope) -> DataFrame:
    """The lists with members of more than one component."""
    spread = posted.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    return scope.stage(posted.join(spread.filter("a < b").select("token"), "token"), "open")


def _sets_of(rows: DataFrame, classes: DataFrame, active: DataFrame, shingle: int) -> DataFrame:
    """``(rep, shingles, sketch)`` of the active classes."""
    texts = rows.join(active.select(F.col("rep").alias("id")), "id", "left_semi")
    sets = texts.mapInArrow(lambda it: _sets(it, shingle), "rep long, f1 long, f2 long, shingles array<long>, sketch array<long>")
    # Rows that share an id may have other sets: only the class's own counts.
    own = classes.select("rep", "f1", "f2").join(active, "rep", "left_semi")
    return sets.join(own, ["rep", "f1", "f2"], "left_semi").dropDuplicates(["rep"]).select("rep", "shingles", "sketch")


def _exact_lists(posted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Open classes under the rarest of the shingles that they share with other components.

    A partner of a class with ``n`` shingles has at least ``m``, the size of the smallest member of its
    lists or the threshold's share of ``n``, so at least ``percent / (100 + percent) * (n + m)`` are common.
    """
    smallest = posted.groupBy("token").agg(F.min("n").alias("least"))
    placed = posted.join(smallest, "token").groupBy("rep", "n", "component").agg(F.min("least").alias("least"))
    own = sets.join(placed, "rep").select("rep", "n", "component", "least", F.explode("shingles").alias("token"))
    where = own.groupBy("token").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("length")
    )
    shared = own.join(where.filter("a < b").select("token", "length"), "token")
    values = shared.groupBy("rep", "n", "component", "least").agg(F.collect_list(F.struct("length", "token")).alias("of"))
    least = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    common = F.ceil((F.col("n") + least) * percent / (100 + percent) - 1e-9).cast("int")
    values = values.withColumn("shared", F.size("of")).withColumn("common", common).filter("shared >= common")
    prefix = F.slice(F.sort_array("of"), F.lit(1), F.col("shared") - F.col("common") + 1)
    values = values.select("rep", "n", "shared", "component", prefix.alias("of")).join(sets.select("rep", "sketch"), "rep")
    exploded = values.select("rep", "n", "shared", "component", "sketch", F.explode("of").alias("at"))
    return exploded.select("at.token", "rep", "n", "shared", "component", "sketch")


def _leaders(posted: DataFrame, limit: int, each: int = 1) -> DataFrame:
    """Of each list up to ``limit`` members: the best of its components, up to ``each`` of one."""
    best = F.struct("shared", -F.col("rep"))
    if limit == 1:
        named = posted.groupBy("token").agg(F.max_by("rep", best).alias("rep"))
    else:
        if each == 1:
            of = posted.groupBy("token", "component").agg(F.max_by("rep", best).alias("rep"), F.max("shared").alias("shared"))
            of = of.withColumn("own", F.lit(1))
        else:
            inside = Window.partitionBy("token", "component").orderBy(F.desc("shared"), "rep")
            of = posted.withColumn("own", F.row_number().over(inside)).filter(F.col("own") <= each)
        # Spark keeps the first rows of each task before it brings a list together.
        order = Window.partitionBy("token").orderBy("own", F.desc("shared"), "rep")
        named = of.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit).select("token", "rep")
    return named.join(posted.drop("shared"), ["token", "rep"])


def _relabelled(table: DataFrame, merged: DataFrame) -> DataFrame:
    joined = table.join(merged, "component", "left")
    return joined.withColumn("component", F.coalesce("to", "component"))


def _across(leaders: DataFrame, posted: DataFrame, percent: int) -> DataFrame:
    """``(i, j)``: each leader with the members of other components that its size and its sketch allow."""
    left = leaders.select("token", F.col("rep").alias("a"), F.col("n").alias("an"), F.col("component").alias("ac"), F.col("sketch").alias("as"))
    right = posted.select("token", F.col("rep").alias("b"), F.col("n").alias("bn"), F.col("component").alias("bc"), F.col("sketch").alias("bs"))
    met = left.join(right, "token").filter("ac != bc")
    met = met.filter(F.least("an", "bn") * 100 >= F.greatest("an", "bn") * percent)
    # At most (an + bn - apart) / 2 are common, and a link has at least percent / (100 + percent) * (an + bn).
    apart = sum((F.bit_count(F.col("as")[k].bitwiseXOR(F.col("bs")[k])) for k in range(BITS // 64)), F.lit(0))
    met = met.filter((F.col("an") + F.col("bn") - apart) * (100 + percent) >= (F.col("an") + F.col("bn")) * (2 * percent))
    return met.select(F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).distinct()


def _matching(pairs: DataFrame, signatures: DataFrame, matches: int) -> DataFrame:
    both = pairs.join(signatures.toDF("i", "si"), "i").join(signatures.toDF("j", "sj"), "j")
    equal = F.size(F.filter(F.zip_with("si", "sj", lambda x, y: x == y), lambda same: same))
    return both.filter(equal >= matches).select("i", "j")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    of = sets.select("rep", "shingles")
    both = pairs.join(of.toDF("i", "si"), "i").join(of.toDF("j", "sj"), "j")
    return both.withColumn("common", F.size(F.array_intersect("si", "sj"))).filter(_similar(percent)).select("i", "j")


def _similar(percent: int) -> Column:
    union = F.size("si") + F.size("sj") - F.col("common")
    return F.col("common").cast("long") * 100 >= union.cast("long") * percent


def _shingles(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Every document's id and the sorted distinct hashes of its shingles."""
    for slab, _ in slabs(batches, lower=True, whole=True, most=HASHED_WORDS):
        keys = rolling(slab.hashes, n)
        for id_, start, size in zip(slab.ids.tolist(), slab.starts.tolist(), slab.lens.tolist(), strict=True):
            if size >= n:
                found = np.sort(keys[start : start + size - n + 1])
                yield id_, found[np.append(True, found[1:] != found[:-1])]
            elif size:
                yield id_, mix(rolling(slab.hashes[start : start + size], size) + np.uint64(size))
            else:
                yield id_, keys[:0]


def _prints(found: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that stand for a set."""
    with np.errstate(over="ignore"):
        one = mix(found + np.uint64(1)).sum(dtype=np.uint64)
        two = mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def sketch(found: np.ndarray) -> np.ndarray:
    """The parities of a set's shingles in ``BITS`` bins."""
    bins = np.bincount((found & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS)
    return np.packbits((bins & 1).astype(np.uint8)).view(np.int64)


def _factors(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(found: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The minimum of every hash function over a set, 32 bits each."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 2048):
        part = factors[:, None] * found[None, start : start + 2048]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def _sign(batches: Iterator[pa.RecordBatch], shingle: int, k: int) -> Iterator[pa.RecordBatch]:
    factors = _factors(k)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        ids, sizes, ones, twos, signatures = zip(*rows, strict=True)
        plain = [pa.array(x, pa.int64()) for x in (ids, sizes, ones, twos)]
        return pa.RecordBatch.from_arrays([*plain, _lists(list(signatures), pa.int32())], ["id", "n", "f1", "f2", "signature"])

    rows = []
    for id_, found in _shingles(batches, shingle):
        of = signature(found, factors) if len(found) else np.empty(0, np.int32)
        rows.append((id_, len(found), *_prints(found), of))
        if len(rows) == 4096:
            yield made(rows)
            rows = []
    if rows:
        yield made(rows)


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    def made(rows: list[tuple]) -> pa.RecordBatch:
        ids, ones, twos, parts, sketches = zip(*rows, strict=True)
        plain = [pa.array(x, pa.int64()) for x in (ids, ones, twos)]
        lists = [_lists(list(x), pa.int64()) for x in (parts, sketches)]
        return pa.RecordBatch.from_arrays([*plain, *lists], ["rep", "f1", "f2", "shingles", "sketch"])

    rows, size = [], 0
    for id_, found in _shingles(batches, shingle):
        rows.append((id_, *_prints(found), found.view(np.int64), sketch(found)))
        size += len(found)
        if size >= 500_000:
            yield made(rows)
            rows, size = [], 0
    if rows:
        yield made(rows)
