"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are grown on a bounded sample (``SAMPLE`` rows in expectation): a node projects its points on
the differences of a few random pairs of them and splits them at the median of the widest projection.
Every row of the table is then dropped into one leaf per tree. A query walks all trees with one shared
priority queue: always the branch that is nearest, in whatever tree, by the sum of the squared distances
to the borders on its path, until the leaves it reached hold ``share`` of the table's rows (a row counts
in every tree), and at least as many as are asked for. Their rows are ranked by their exact distance.

Equal vectors are one row of the forest, which carries its smallest ids, as many as can be asked for: copies
use up neither the sample nor a query's share, and come back when they are ranked. Since a missed row would
then miss all its copies, the ``HOT`` most repeated vectors are ranked for every query besides.

How much must be looked at depends on the vectors. The default reaches a recall of 0.9 for points without
any structure in 64 dimensions, the worst case; clustered vectors need a small part of it.

Leaf sizes and visits are counted first. A leaf with many rows or many visiting queries, as duplicates
make it, is dealt into blocks, so a group that meets in one task is bounded on both sides. Only the trees
and the counts per leaf, whose sizes the parameters bound, are sent to the tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.session import Scope

TREES = 16
LEAF = 256
SHARE = 0.75
# A query looks at this many rows at least, so that small tables are searched whole.
LEAST_SEARCH = 10_000
# Random pairs of points whose differences a split chooses from, and points that it is judged by.
DIRECTIONS = 16
JUDGED = 500
SAMPLE = 20_000
# A leaf has at least this many rows of the sample, which bounds the number of leaves.
LEAST_SAMPLED = 8
# Equal vectors are brought together in so many groups first, so that a hot one doesn't meet in one task.
GROUPS = 16
HOT = 1024
BLOCK_ROWS = 4096
BLOCK_QUERIES = 2048
# Queries that are routed at a time, leaves of rows or queries that are dealt at a time, and rows of a batch that leaves
# a task: a query visits the more leaves the larger the table is.
ROUTED = 256
ENTRIES = 65_536
DEALT = 8_192


@dataclass(frozen=True)
class Tree:
    """Inner nodes with a normal and an offset; a child below 0 is the leaf ``-1 - child``."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        if not len(self.normals):
            return at
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = (np.einsum("ij,ij->i", rows[inner], self.normals[node]) > self.offsets[node]).astype(np.int64)
            at[inner] = self.children[node, side]
        return -1 - at


def grow(points: np.ndarray, leaf: int, draw: np.random.Generator) -> Tree:
    normals, offsets, children = [], [], []
    leaves = 0

    def split(at: np.ndarray) -> int:
        nonlocal leaves
        if len(at) > leaf:
            ends = points[draw.choice(at, (2, DIRECTIONS))]
            across = ends[0] - ends[1]
            lengths = np.linalg.norm(across, axis=1)
            across = across[lengths > 0] / lengths[lengths > 0, None]
            judged = at if len(at) <= JUDGED else draw.choice(at, JUDGED, replace=False)
            spread = (points[judged] @ across.T).var(axis=0)
            for normal in across[np.argsort(-spread)]:
                along = points[at] @ normal
                middle = np.median(along)
                right = along > middle
                if right.any() and not right.all():
                    node = len(normals)
                    normals.append(normal)
                    offsets.append(middle)
                    children.append([0, 0])
                    children[node][:] = [split(at[~right]), split(at[right])]
                    return node
        leaves += 1
        return -leaves

    split(np.arange(len(points)))
    size = points.shape[1]
    return Tree(np.array(normals).reshape(-1, size), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), leaves)


@dataclass(frozen=True)
class Forest:
    trees: list[Tree]

    @property
    def first(self) -> np.ndarray:
        """The number of the first leaf of each tree; leaves are numbered through."""
        return np.cumsum([0, *(tree.leaves for tree in self.trees)])

    def leaves_of(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([tree.leaf_of(rows) + f for tree, f in zip(self.trees, self.first[:-1], strict=True)], axis=1)

    def visit(self, query: np.ndarray, sizes: np.ndarray, search: int, least: int) -> list[int]:
        """The leaves a query looks into: the nearest branches first over all trees.

        It stops when they hold ``search`` rows and one tree's hold ``least`` (so many different rows).
        """
        queue: list[tuple[float, int, int]] = [(0.0, t, 0 if len(tree.normals) else -1) for t, tree in enumerate(self.trees)]
        heapq.heapify(queue)
        margins = [tree.normals @ query - tree.offsets if len(tree.normals) else tree.offsets for tree in self.trees]
        first, total, found = self.first, 0, []
        by_tree = np.zeros(len(self.trees), np.int64)
        while queue and (total < search or by_tree.max() < least):
            border, t, node = heapq.heappop(queue)
            children = self.trees[t].children
            while node >= 0:
                margin = float(margins[t][node])
                near = int(margin > 0)
                heapq.heappush(queue, (border + margin * margin, t, int(children[node, 1 - near])))
                node = int(children[node, near])
            leaf = int(first[t]) - 1 - node
            if sizes[leaf]:
                found.append(leaf)
                total += int(sizes[leaf])
                by_tree[t] += int(sizes[leaf])
        return found


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vector)`` of the rows that take part.

    Left out are null ids, and vectors that are null, zero, hold null or non-finite components, or have
    another length than most (ties: the shorter). Floats stay floats, other numbers become doubles.
    """
    kind = dict(table.dtypes)[vector_col]
    vector = F.col(vector_col) if kind == "array<float>" else F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.filter(F.size("vector") == (lengths["size"] if lengths else -1))


def nearest(
    table: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    trees: int = TREES,
    leaf: int = LEAF,
    share: float = SHARE,
    least_search: int = LEAST_SEARCH,
    sample: int = SAMPLE,
) -> tuple[DataFrame, Scope]:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest rows found, by Euclidean distance.

    ``queries`` is a condition on ``id``; a query is no candidate of its own. Fewer than ``k`` candidates
    are all returned; ties go to the smaller id; rows that share an id count once, with the nearest of
    their vectors. Distances are computed in double precision from the vectors as they are.
    """
    scope = Scope(table.sparkSession)
    rows = valid_vectors(table, id_col, vector_col)
    kind = dict(rows.dtypes)["vector"]
    distinct = scope.stage(_collapsed(rows, k + 1), "vectors")
    total = distinct.count()
    search = max(least_search, int(share * total))
    place = F.pmod(F.xxhash64(F.lit("forest"), "id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = distinct.filter(place < sample / max(1, total)).orderBy("id", "vector").collect() if total else []
    points = np.array([r.vector for r in chosen], np.float64)
    draw = np.random.default_rng(5)
    own_leaf = max(LEAST_SAMPLED, int(leaf * len(points) / max(1, total)))
    forest = Forest([grow(points, own_leaf, draw) for _ in range(trees)] if len(points) else [_one_leaf() for _ in range(trees)])
    placed = scope.stage(
        distinct.select("id", "vector", "ids").mapInArrow(lambda it: _placed(it, forest), f"id long, vector {kind}, ids array<long>, leaves array<int>"), "placed"
    )
    sizes = _per_leaf(placed, forest)
    routed = scope.stage(
        rows.filter(queries).mapInArrow(
            lambda it: _routed(it, forest, sizes, search, k + 1), f"id long, vector {kind}, ids array<long>, leaves array<int>"
        ),
        "routed",
    )
    visits = _per_leaf(routed, forest)
    row_blocks, query_blocks = -(-sizes // BLOCK_ROWS), -(-visits // BLOCK_QUERIES)
    met = f"leaf int, block int, part int, is_query boolean, id long, vector {kind}, ids array<long>"
    both = placed.mapInArrow(lambda it: _dealt(it, row_blocks, query_blocks, False), met).unionAll(
        routed.mapInArrow(lambda it: _dealt(it, row_blocks, query_blocks, True), met)
    )
    found = both.groupBy("leaf", "block", "part").applyInArrow(
        lambda t: _ranked(t, k), "query_id long, vec_id long, score double"
    )
    top = distinct.filter("copies > 1").orderBy(F.desc("copies"), "id", "vector").limit(HOT).collect()
    if top:
        hot, members = np.array([r.vector for r in top], np.float64), [np.array(r.ids, np.int64) for r in top]
        found = found.unionAll(
            routed.select("id", "vector").mapInArrow(lambda it: _hot(it, hot, members, k), "query_id long, vec_id long, score double")
        )
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score"), scope


def _collapsed(rows: DataFrame, members: int) -> DataFrame:
    """``(id, vector, ids, copies)``: every vector once with its ``members`` smallest ids, the smallest as ``id``."""
    kind = dict(rows.dtypes)["vector"]
    smallest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, members).alias("ids")
    found = rows.mapInArrow(lambda it: _members(it, members), f"group int, vector {kind}, ids array<long>, copies long")
    copies = F.sum("copies").alias("copies")
    found = found.groupBy("vector", "group").agg(smallest, copies).groupBy("vector").agg(smallest, copies)
    return found.select(F.col("ids")[0].alias("id"), "vector", "ids", "copies")


def _members(batches: Iterator[pa.RecordBatch], members: int) -> Iterator[pa.RecordBatch]:
    """The vectors of each batch once."""
    group = TaskContext.get().partitionId() % GROUPS
    for batch in batches:
        if batch.num_rows:
            ids, vectors = batch.column(0).to_numpy(), np.ascontiguousarray(_matrix(batch.column(1)) + 0.0)
            keys = vectors.view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
            _, first, own, copies = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            order = np.lexsort((ids, own))
            parts = np.split(ids[order], np.flatnonzero(np.diff(own[order])) + 1)
            parts = [np.unique(part)[:members] for part in parts]
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(first), group), pa.int32()), batch.column(1).take(pa.array(first)), lists, pa.array(copies, pa.int64())],
                ["group", "vector", "ids", "copies"],
            )


def _one_leaf() -> Tree:
    return Tree(np.empty((0, 0)), np.empty(0), np.empty((0, 2), np.int64), 1)


def _per_leaf(rows: DataFrame, forest: Forest) -> np.ndarray:
    """Rows per leaf: one number for each leaf of the forest."""
    counts = np.zeros(int(forest.first[-1]), np.int64)
    for leaf, n in rows.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        counts[leaf] = n
    return counts


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _leaf_lists(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    flat = np.concatenate(lists) if lists else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _placed(batches: Iterator[pa.RecordBatch], forest: Forest) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            leaves = _leaf_lists(list(forest.leaves_of(_matrix(batch.column(1))).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, leaves], ["id", "vector", "ids", "leaves"])


def _routed(
    batches: Iterator[pa.RecordBatch], forest: Forest, sizes: np.ndarray, search: int, least: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROUTED):
            piece = batch.slice(start, ROUTED)
            found = [np.array(forest.visit(q, sizes, search, least), np.int32) for q in _matrix(piece.column(1))]
            none = pa.nulls(piece.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*piece.columns, none, _leaf_lists(found)], ["id", "vector", "ids", "leaves"])


def _dealt(
    batches: Iterator[pa.RecordBatch], row_blocks: np.ndarray, query_blocks: np.ndarray, is_query: bool
) -> Iterator[pa.RecordBatch]:
    """One row per group in which a row or a query takes part.

    A row lies in one block of its leaf and meets all parts of the queries; a query the other way round.
    """
    own, other = (query_blocks, row_blocks) if is_query else (row_blocks, query_blocks)
    for batch in batches:
        ends = np.cumsum(batch.column(3).value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + ENTRIES, "right")))
            piece = batch.slice(start, stop - start)
            start = stop
            leaves = piece.column(3)
            lens = leaves.value_lengths().to_numpy(zero_copy_only=False)
            at, leaf = np.repeat(np.arange(piece.num_rows), lens), leaves.flatten().to_numpy().astype(np.int64)
            ids = piece.column(0).to_numpy()
            mine = np.abs((ids[at] * 2654435761) >> 7) % np.maximum(own[leaf], 1)
            copies = other[leaf]
            upto = np.cumsum(copies)
            total = int(upto[-1]) if len(upto) else 0
            for first in range(0, total, DEALT):
                row = np.arange(first, min(first + DEALT, total))
                entry = np.searchsorted(upto, row, "right")
                theirs = row - (upto - copies)[entry]
                block, part = (theirs, mine[entry]) if is_query else (mine[entry], theirs)
                taken = piece.select([0, 1, 2]).take(pa.array(at[entry]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[entry], pa.int32()), pa.array(block, pa.int32()), pa.array(part, pa.int32()),
                     pa.array(np.full(len(row), is_query)), *taken.columns],
                    ["leaf", "block", "part", "is_query", "id", "vector", "ids"],
                )


def _ranked(table: pa.Table, k: int) -> pa.Table:
    """The nearest rows of one group for each query of it."""
    table = table.combine_chunks()
    is_query = table["is_query"].to_numpy()
    ids, vectors = table["id"].to_numpy(), _matrix(table["vector"].combine_chunks())
    members = table.filter(pa.array(~is_query))["ids"].combine_chunks()
    lens = members.value_lengths().to_numpy()
    return pa.table(_best(ids[is_query], vectors[is_query], vectors[~is_query], members.flatten().to_numpy(), lens, k))


def _hot(batches: Iterator[pa.RecordBatch], hot: np.ndarray, members: list[np.ndarray], k: int) -> Iterator[pa.RecordBatch]:
    """The nearest of the most repeated vectors for each query."""
    row_ids, lens = np.concatenate(members), np.array([len(m) for m in members])
    for batch in batches:
        if batch.num_rows:
            ids, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1))
            yield pa.RecordBatch.from_pydict(_best(ids, vectors, hot, row_ids, lens, k))


def _best(
    ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, lens: np.ndarray, k: int
) -> dict[str, pa.Array]:
    """Each query's nearest ids; a row has ``lens`` of ``row_ids``."""
    row = np.repeat(np.arange(len(rows)), lens)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for query, vector in zip(ids, vectors, strict=True):
        distance = np.sqrt(((rows - vector) ** 2).sum(axis=1))[row]
        others = np.flatnonzero(row_ids != query)
        # An id in several rows of one group counts once, so more than k may be looked at.
        order = others[np.lexsort((row_ids[others], distance[others]))]
        _, first = np.unique(row_ids[order], return_index=True)
        order = order[np.sort(first)[:k]]
        out.append((np.full(len(order), query), row_ids[order], distance[order]))
    parts = list(zip(*out, strict=True)) or [[], [], []]
    query_ids, vec_ids, scores = (np.concatenate(p) if len(p) else np.empty(0, np.int64) for p in parts)
    return {
        "query_id": pa.array(query_ids, pa.int64()),
        "vec_id": pa.array(vec_ids, pa.int64()),
        "score": pa.array(scores.astype(np.float64)),
    }
