"""Embedding near-dedup through hierarchical navigable small-world graphs, one per shard.

1. Rows with equal vectors are one *class*; classes are dealt to shards by a hash. Shards hold ``SHARD_CELLS``
   numbers, and as the table grows both they and their number grow with its root, up to ``MOST_CELLS``: a search
   costs little more in a larger graph, but every vector searches all of them.
2. Each shard builds a graph (Malkov and Yashunin 2016) by inserting batches, from the highest layer down. A
   vector within half the link angle of a node that is already there joins its *ball* and is no node: any two of
   a ball are linked by the triangle inequality. So a family of near copies is a few nodes, not a clique.
3. The shard audits its graph: vectors planted at up to the link angle from some of its nodes are searched, and
   the beam is widened until the recall of a brute-force search reaches ``RECALL``.
4. Every vector queries every shard with the shard's beam; while half of the beam are hits, it is widened for
   that vector. What is dealt to a task is one shard's graph and as many queries, so tasks stay of one size.
5. A ball that is hit is settled by angles to its centre: members that must be linked, and members that can't
   be, are counted from sorted angles; only what is in doubt is verified, by the cosine of the original vectors
   in double precision. A pair below the threshold is never linked.
6. Link counts add up over shards, with classes counted by their copies. Balls are the nodes of the table of
   links whose connected components are united: one row for any two balls of a task, no pairs of vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.components import components
from gristmill.session import Scope

COSINE = 0.9
# Numbers of a shard's vectors: 16,384 vectors of 64 numbers.
SHARD_CELLS = 1 << 20
# The largest shard, held whole by a task: 131,072 vectors of 64 numbers.
MOST_CELLS = 1 << 23
# The beam is widened until so many of the audited links are found.
RECALL = 0.99
AUDITED = 256
NEIGHBOURS, BUILD_BEAM, LEAST_BEAM = 16, 64, 32
BATCH = 512
# Angles closer than this to a border are settled by the cosine itself.
_DOUBT = 1e-6


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


class Graph:
    """Nodes in order of insertion, those of higher layers first; a layer has the first ``sizes[l]`` nodes."""

    def __init__(self, dimensions: int) -> None:
        self.vectors = np.empty((0, dimensions), np.float32)
        self.sizes: list[int] = []
        self.links: list[np.ndarray] = []

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and cosines of the best ``beam`` nodes found for every query, best first; -1 where there are fewer."""
        at = np.zeros((len(queries), 1), np.int64)
        for layer in range(len(self.sizes) - 1, 0, -1):
            at, _ = self._walk(layer, queries, at, 8)
            # A layer that is being filled does not have all of the nodes above it yet.
            at = -np.sort(-np.where(at[:, :4] < self.sizes[layer - 1], at[:, :4], 0), axis=1)
            at[:, 1:][at[:, 1:] == at[:, :-1]] = -1
        return self._walk(0, queries, at, beam)

    def _walk(self, layer: int, queries: np.ndarray, starts: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        links, many = self.links[layer], len(queries)
        rows = np.arange(many)[:, None]
        seen = np.zeros((many, self.sizes[layer] + 1), bool)
        # The last column takes all that is no node.
        seen[:, -1] = True
        seen[rows, starts] = True
        nodes, cosines = starts.copy(), self._cosines(queries, starts)
        opened = np.zeros(nodes.shape, bool)
        step = max(1, min(4, beam // 8))
        while True:
            # The best nodes of each beam that were not opened yet.
            rank = np.where(opened | (nodes < 0), -np.inf, cosines)
            best = np.argsort(-rank, axis=1, kind="stable")[:, :step]
            fresh = np.take_along_axis(rank, best, 1) > -np.inf
            going = np.flatnonzero(fresh.any(axis=1))
            if not len(going):
                return nodes, cosines
            best, fresh, part = best[going], fresh[going], going[:, None]
            opened[part, best] |= fresh
            origin = np.where(fresh, nodes[part, best], -1)
            reached = np.where(origin[:, :, None] >= 0, links[origin], -1).reshape(len(going), -1)
            reached = np.where(seen[part, reached], -1, reached)
            # The same node may be reached twice at once.
            reached = -np.sort(-reached, axis=1)
            reached[:, 1:][reached[:, 1:] == reached[:, :-1]] = -1
            reached = -np.sort(-reached, axis=1)
            reached = reached[:, : max(1, int((reached >= 0).sum(axis=1).max()))]
            seen[part, reached] = True
            found = self._cosines(queries[going], reached)
            width = max(nodes.shape[1], min(beam, nodes.shape[1] + reached.shape[1]))
            if width > nodes.shape[1]:
                more = width - nodes.shape[1]
                nodes = np.pad(nodes, ((0, 0), (0, more)), constant_values=-1)
                cosines = np.pad(cosines, ((0, 0), (0, more)), constant_values=-np.inf)
                opened = np.pad(opened, ((0, 0), (0, more)))
            all_nodes = np.concatenate([nodes[going], reached], axis=1)
            all_cosines = np.concatenate([cosines[going], found], axis=1)
            all_opened = np.concatenate([opened[going], np.zeros(reached.shape, bool)], axis=1)
            order = np.argsort(-all_cosines, axis=1, kind="stable")[:, :width]
            nodes[going] = np.take_along_axis(all_nodes, order, 1)
            cosines[going] = np.take_along_axis(all_cosines, order, 1)
            opened[going] = np.take_along_axis(all_opened, order, 1)

    def _cosines(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        found = np.matmul(self.vectors[nodes], queries[:, :, None])[:, :, 0]
        return np.where(nodes < 0, -np.inf, found)

    def add_layer(self) -> None:
        """A new lowest layer over all nodes so far."""
        self.sizes.insert(0, 0)
        self.links.insert(0, np.empty((0, 2 * NEIGHBOURS), np.int64))
        for start in range(0, len(self.vectors), BATCH):
            self._connect(self.vectors[start : start + BATCH])

    def insert(self, vectors: np.ndarray) -> None:
        """New nodes in the lowest layer."""
        self.vectors = np.concatenate([self.vectors, vectors])
        self._connect(vectors)

    def _connect(self, vectors: np.ndarray) -> None:
        """Links between the next nodes of the lowest layer, whose vectors these are, and those before them."""
        first, many = self.sizes[0], len(vectors)
        own = vectors @ vectors.T
        np.fill_diagonal(own, -np.inf)
        nearest = np.argsort(-own, axis=1, kind="stable")[:, : min(many - 1, BUILD_BEAM)]
        nodes, cosines = nearest + first, np.take_along_axis(own, nearest, 1)
        if first:
            before, towards = self.search(vectors, BUILD_BEAM)
            nodes, cosines = np.concatenate([before, nodes], axis=1), np.concatenate([towards, cosines], axis=1)
            order = np.argsort(-cosines, axis=1, kind="stable")[:, :BUILD_BEAM]
            nodes, cosines = np.take_along_axis(nodes, order, 1), np.take_along_axis(cosines, order, 1)
        self.sizes[0] += many
        self.links[0] = np.concatenate([self.links[0], np.full((many, 2 * NEIGHBOURS), -1)])
        if not nodes.shape[1]:
            return
        chosen = self._diverse(nodes, cosines)
        self.links[0][first:, :NEIGHBOURS] = chosen
        source, place = np.nonzero(chosen >= 0)
        self._back(chosen[source, place], source + first)

    def _diverse(self, nodes: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        """Up to ``NEIGHBOURS`` of the candidates, none nearer to one taken before than to the node; then the nearest others."""
        between = np.matmul(self.vectors[nodes], self.vectors[nodes].transpose(0, 2, 1))
        many, width = nodes.shape
        taken = np.zeros((many, width), bool)
        barred = np.full((many, width), -np.inf, np.float32)
        for k in range(width):
            take = (barred[:, k] < cosines[:, k]) & (nodes[:, k] >= 0) & (taken.sum(axis=1) < NEIGHBOURS)
            taken[:, k] = take
            barred = np.where(take[:, None], np.maximum(barred, between[:, k, :]), barred)
        # Taken ones first, then the rest, each by nearness.
        order = np.argsort(~taken, axis=1, kind="stable")[:, :NEIGHBOURS]
        found = np.take_along_axis(nodes, order, 1)
        return np.pad(found, ((0, 0), (0, NEIGHBOURS - found.shape[1])), constant_values=-1)

    def _back(self, nodes: np.ndarray, sources: np.ndarray) -> None:
        """Links back from ``nodes`` to ``sources``; a node keeps its nearest ones when it has too many."""
        links, width = self.links[0], 2 * NEIGHBOURS
        order = np.argsort(nodes, kind="stable")
        nodes, sources = nodes[order], sources[order]
        first = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
        sizes = np.diff(np.append(first, len(nodes)))
        for low in range(0, len(first), 1024):
            begin, size = first[low : low + 1024], sizes[low : low + 1024]
            at = nodes[begin]
            new = np.full((len(at), int(size.max())), -1)
            inside = np.arange(new.shape[1]) < size[:, None]
            new[inside] = sources[begin[0] : begin[0] + int(size.sum())]
            both = np.concatenate([links[at], new], axis=1)
            cosines = np.where(both < 0, -np.inf, np.matmul(self.vectors[both], self.vectors[at][:, :, None])[:, :, 0])
            # A link that is there already counts once.
            by_node = np.argsort(-both, axis=1, kind="stable")
            both, cosines = np.take_along_axis(both, by_node, 1), np.take_along_axis(cosines, by_node, 1)
            again = np.pad(both[:, 1:] == both[:, :-1], ((0, 0), (1, 0)))
            both, cosines = np.where(again, -1, both), np.where(again, -np.inf, cosines)
            best = np.argsort(-cosines, axis=1, kind="stable")[:, :width]
            links[at] = np.take_along_axis(both, best, 1)


def build(units: np.ndarray, levels: np.ndarray, least: float) -> tuple[Graph, np.ndarray, np.ndarray]:
    """The graph of unit vectors, the vectors that are its nodes, and every vector's node.

    A vector whose cosine to a node is ``least`` or more belongs to the ball of that node.
    """
    graph = Graph(units.shape[1])
    plain = units.astype(np.float32)
    centres: list[int] = []
    ball = np.full(len(units), -1)
    for level in range(int(levels.max()), -1, -1):
        graph.add_layer()
        members = np.flatnonzero(levels == level)
        for start in range(0, len(members), BATCH):
            part = members[start : start + BATCH]
            if centres:
                nodes, _ = graph.search(plain[part], BUILD_BEAM)
                nearest = nodes[:, 0]
                cosines = (units[part] * units[np.array(centres)[nearest]]).sum(axis=1)
                joins = cosines >= least
                ball[part[joins]] = nearest[joins]
                part = part[~joins]
            own = units[part] @ units[part].T >= least
            new: list[int] = []
            for k in range(len(part)):
                centre = next((j for j in new if own[k, j]), None) if own[k, :k].any() else None
                if centre is None:
                    new.append(k)
                    ball[part[k]] = len(centres)
                    centres.append(int(part[k]))
                else:
                    ball[part[k]] = ball[part[centre]]
            if new:
                graph.insert(plain[part[new]])
    return graph, np.array(centres), ball


class Shard:
    """A graph with the members of its balls, to be queried."""

    def __init__(self, graph: Graph, units: np.ndarray, ball: np.ndarray, centres: np.ndarray, cosine: float) -> None:
        self.graph, self.units, self.ball, self.cosine = graph, units, ball, cosine
        self.reach = math.acos(cosine)
        self.centres = centres
        angle = _angles((units * units[centres[ball]]).sum(axis=1))
        angle[centres] = 0
        order = np.lexsort((angle, ball))
        self.members, self.angle = order, angle[order]
        self.start = np.searchsorted(ball[order], np.arange(len(centres) + 1))
        self.radius = np.zeros(len(centres))
        np.maximum.at(self.radius, ball, angle)

    def hits(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) whose angle is at most the reach and the ball's radius."""
        found_q, found_n = [], []
        left, plain = np.arange(len(queries)), queries.astype(np.float32)
        while len(left):
            nodes, cosines = self.graph.search(plain[left], beam)
            # The graph is searched in single precision; a hit needs no more than a little beyond the border.
            near = (nodes >= 0) & (cosines >= np.cos(np.minimum(self.reach + self.radius[nodes] + 1e-3, math.pi)))
            # Where half of the beam are hits there may be more of them.
            wide = (near.sum(axis=1) * 2 >= beam) if beam < len(self.centres) else np.zeros(len(left), bool)
            q, k = np.nonzero(near & ~wide[:, None])
            found_q.append(left[q])
            found_n.append(nodes[q, k])
            left, beam = left[wide], beam * 2
        return np.concatenate([*found_q, np.empty(0, np.int64)]), np.concatenate([*found_n, np.empty(0, np.int64)])

    def audit(self, seed: int = 0) -> tuple[int, float]:
        """The beam at which planted vectors find ``RECALL`` of what brute force finds, and the recall."""
        draw = np.random.default_rng(seed)
        many = len(self.centres)
        chosen = self.units[self.centres[draw.permutation(many)[:AUDITED]]]
        aside = draw.standard_normal(chosen.shape)
        aside -= (aside * chosen).sum(axis=1, keepdims=True) * chosen
        norms = np.linalg.norm(aside, axis=1, keepdims=True)
        turn = self.reach * draw.uniform(0.3, 1, (len(chosen), 1))
        planted = np.where(norms > 1e-9, np.cos(turn) * chosen + np.sin(turn) * aside / np.where(norms > 1e-9, norms, 1), chosen)
        true = planted @ self.units[self.centres].T >= np.cos(np.minimum(self.reach + self.radius + 1e-3, math.pi))
        beam = LEAST_BEAM
        while True:
            q, n = self.hits(planted, beam)
            recall = float(true[q, n].sum() / max(1, true.sum()))
            if recall >= RECALL or beam >= many:
                return beam, recall
            beam *= 2

    def linked(
        self, queries: np.ndarray, beam: int, weights: np.ndarray, own: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How much weight is linked with every query, and the linked pairs (query, node).

        ``own`` is a query's ball in this shard, or -1; it is hit whether the search finds it or not.
        """
        q, n = self.hits(queries, beam)
        at = np.flatnonzero(own >= 0)
        both = np.unique(np.stack([np.concatenate([q, at]), np.concatenate([n, own[at]])], axis=1), axis=0)
        q, n = both[:, 0], both[:, 1]
        angle = _angles((queries[q] * self.units[self.centres[n]]).sum(axis=1))
        total = np.concatenate([[0], np.cumsum(weights[self.members])])
        count = np.zeros(len(queries), np.int64)
        linked = np.zeros(len(q), bool)
        for k, (query, node) in enumerate(zip(q.tolist(), n.tolist(), strict=True)):
            low, high = int(self.start[node]), int(self.start[node + 1])
            inside = self.angle[low:high]
            sure = low + int(np.searchsorted(inside, self.reach - angle[k] - _DOUBT, "right"))
            if own[query] == node:
                # All of a ball are linked with each other.
                sure = high
            first = max(sure, low + int(np.searchsorted(inside, angle[k] - self.reach - _DOUBT, "left")))
            last = low + int(np.searchsorted(inside, angle[k] + self.reach + _DOUBT, "right"))
            amount = int(total[sure] - total[low])
            if first < last:
                doubt = self.members[first:last]
                good = self.units[doubt] @ queries[query] >= self.cosine
                amount += int(weights[doubt[good]].sum())
            count[query] += amount
            linked[k] = amount > 0
        return count, q[linked], n[linked]


_FOUND = "vec long, n long, a long, b long"


def near_vectors(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, shard_cells: int = SHARD_CELLS
) -> tuple[DataFrame, Scope]:
    """``(vec_id, n_links, component_id, kept)`` of every row with an id, and the owner of the staged tables.

    Vectors are linked if their cosine is ``cosine`` (between 0 and 1) or more. ``n_links`` counts the other rows
    that a row is linked with, equal vectors included; ``component_id`` is the smallest id that is reachable,
    itself included. Vectors that are null, empty, zero, or hold null or non-finite numbers link with nothing, nor
    do vectors of different lengths with each other. Rows that repeat an id are vectors of their own, each with
    its links, but one node of the components. Other columns don't matter; an empty table gives an empty result.
    Equal vectors are told by 64-bit hashes. What the search misses is bounded by the audits, not by a cap.
    """
    if not 0 < cosine < 1:
        raise ValueError("the cosine must be between 0 and 1")
    scope = Scope(table.sparkSession)
    kind = "array<float>" if "float" in table.schema[vector_col].dataType.simpleString() else "array<double>"
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("vector")).filter("id is not null")
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("vec", F.when(usable, F.xxhash64("vector")))
    classes = rows.filter("vec is not null").groupBy("vec").agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"))
    classes = scope.stage(classes.withColumn("dimensions", F.size("vector").cast("long")), "classes")
    sizes = classes.groupBy("dimensions").agg(F.count(F.lit(1)).alias("many"))
    dealt = classes.join(sizes.select("dimensions", _shards(shard_cells).alias("shards")), "dimensions")
    shard = F.shiftleft("dimensions", 32) + F.pmod(F.xxhash64("vec", F.lit("shard")), F.col("shards"))
    dealt = dealt.select(shard.alias("shard"), "shards", "vec", "copies", "vector")
    schema = f"shard long, shards long, vec long, copies long, vector {kind}, ball long, node long, centre boolean, level int, links binary, beam long, recall double"
    placed = scope.stage(dealt.groupBy("shard").applyInArrow(lambda part: _placed(part, cosine), schema), "graphs")
    found = scope.stage(_dealt_queries(placed).mapInArrow(lambda it: _queried(it, cosine), _FOUND), "found")
    # Every class counted itself with its copies.
    counts = found.filter("vec is not null").groupBy("vec").agg((F.sum("n") - 1).alias("n_links"))
    united = components(found.filter("vec is null").select(F.col("a").alias("i"), F.col("b").alias("j")), scope)
    labels = placed.select("vec", "ball").join(united.withColumnRenamed("id", "ball"), "ball", "left")
    labels = labels.select("vec", F.coalesce("component", "ball").alias("label")).join(counts, "vec")
    members = scope.stage(rows.select("id", "vec").join(labels, "vec", "left"), "members")
    least = members.filter("label is not null").groupBy("label").agg(F.min("id").alias("least"))
    named = members.join(least, "label", "left").withColumn("least", F.coalesce("least", "id"))
    # Rows that share an id connect their components.
    twice = named.groupBy("id").agg(F.min("least").alias("low"), F.max("least").alias("high"))
    joined = scope.stage(twice.filter("low < high").select(F.col("low").alias("i"), F.col("high").alias("j")), "joined")
    if not joined.isEmpty():
        further = components(joined, scope).select(F.col("id").alias("least"), F.col("component").alias("final"))
        named = named.join(further, "least", "left").withColumn("least", F.coalesce("final", "least"))
    n_links = F.coalesce("n_links", F.lit(0)).alias("n_links")
    result = named.select(F.col("id").alias("vec_id"), n_links, F.col("least").alias("component_id"))
    return result.withColumn("kept", F.col("vec_id") == F.col("component_id")), scope


def _shards(shard_cells: int) -> Column:
    """How many shards ``many`` vectors of ``dimensions`` numbers are dealt to."""
    cells = F.col("many") * F.col("dimensions")
    return F.greatest(F.ceil(F.sqrt(cells / shard_cells)), F.ceil(cells / max(MOST_CELLS, shard_cells))).cast("long")


def _dealt_queries(placed: DataFrame) -> DataFrame:
    """For each shard and part of the queries: the shard's rows, then the queries of all shards of its dimension."""
    every = F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)
    common = ["vec", "copies", "vector", "ball", "node"]
    index = placed.select(
        F.col("shard").alias("target"), F.explode(every).alias("part"), F.lit(0).alias("place"), "shard", *common, "centre", "level", "links", "beam"
    )
    part = F.pmod(F.xxhash64("vec", F.lit("part")), F.col("shards"))
    first = F.shiftleft(F.shiftright("shard", 32), 32)
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("centre", "boolean"), ("level", "int"), ("links", "binary"), ("beam", "long"))]
    queries = placed.select(
        F.explode(F.transform(every, lambda k: first + k)).alias("target"), part.alias("part"), F.lit(1).alias("place"), "shard", *common, *none
    )
    key = ["target", "part"]
    return index.unionAll(queries).repartition(*key).sortWithinPartitions(*key, "place", "node", F.desc("centre"), "vec")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([part.flatten().to_numpy().reshape(len(part), -1) for part in parts]).astype(np.float64)


def _placed(part: pa.Table, cosine: float) -> pa.Table:
    """The rows of a shard with their balls and, for centres, their layer and links."""
    # The order of insertion is that of the hashes, whatever order the rows come in.
    part = part.sort_by("vec")
    vec = part.column("vec").to_numpy()
    units = _unit(_matrix(part.column("vector")))
    draw = ((vec.view(np.uint64) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    levels = np.floor(-np.log(draw) / math.log(NEIGHBOURS)).astype(int)
    graph, centres, ball = build(units, levels, math.cos(math.acos(cosine) / 2 - _DOUBT))
    beam, recall = Shard(graph, units, ball, centres, cosine).audit()
    links: list[bytes | None] = [None] * len(vec)
    level = np.full(len(vec), -1)
    for node, row in enumerate(centres.tolist()):
        layers = [table[node] for table, size in zip(graph.links, graph.sizes, strict=True) if node < size]
        links[row], level[row] = np.concatenate(layers).astype(np.int32).tobytes(), len(layers)
    centre = level > 0
    added = {
        "ball": pa.array(vec[centres[ball]]), "node": pa.array(ball), "centre": pa.array(centre), "level": pa.array(level, pa.int32()),
        "links": pa.array(links, pa.binary()), "beam": pa.array(np.full(len(vec), beam)), "recall": pa.array(np.full(len(vec), recall)),
    }
    for name, values in added.items():
        part = part.append_column(name, values)
    return part.select(["shard", "shards", "vec", "copies", "vector", *added])


def _reread(table: pa.Table, cosine: float) -> Shard:
    """The shard that ``_placed`` wrote, its rows sorted by node, centres first."""
    units, ball = _unit(_matrix(table.column("vector"))), table.column("node").to_numpy()
    centres = np.flatnonzero(table.column("centre").to_numpy())
    level = table.column("level").to_numpy()[centres]
    graph = Graph(units.shape[1])
    graph.vectors = units[centres].astype(np.float32)
    flat = [np.frombuffer(value, np.int32) for value in table.column("links").take(pa.array(centres)).to_pylist()]
    width = 2 * NEIGHBOURS
    for layer in range(int(level.max())):
        size = int((level > layer).sum())
        graph.sizes.append(size)
        graph.links.append(np.stack([row[layer * width : (layer + 1) * width] for row in flat[:size]]).astype(np.int64))
    return Shard(graph, units, ball, centres, cosine)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of equal ``(target, part, place)``."""
    keys = np.stack([batch.column(batch.schema.get_field_index(name)).to_numpy() for name in ("target", "part", "place")], axis=1)
    first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
    for low, high in zip(first, [*first[1:], len(keys)], strict=True):
        yield tuple(keys[low].tolist()), batch.slice(low, high - low)


def _queried(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Link counts of the queries, and the pairs of balls that are linked."""
    name, shard = None, None
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        for key, piece in _runs(batch):
            if key[:2] != name:
                name, shard, parts = key[:2], None, []
            if key[2] == 0:
                parts.append(piece)
                continue
            if shard is None:
                table = pa.Table.from_batches(parts)
                shard, parts = _reread(table, cosine), []
                weights, balls = table.column("copies").to_numpy(), table.column("ball").to_numpy()
                beam = table.column("beam")[0].as_py()
            for start in range(0, piece.num_rows, BATCH):
                yield _answers(shard, piece.slice(start, BATCH), key[0], beam, weights, balls)


def _answers(shard: Shard, piece: pa.RecordBatch, target: int, beam: int, weights: np.ndarray, balls: np.ndarray) -> pa.RecordBatch:
    at = piece.schema.get_field_index
    vec, ball = (piece.column(at(c)).to_numpy() for c in ("vec", "ball"))
    own = np.where(piece.column(at("shard")).to_numpy() == target, piece.column(at("node")).to_numpy(), -1)
    count, q, n = shard.linked(_unit(_matrix(piece.column(at("vector")))), beam, weights, own)
    pairs = np.stack([ball[q], balls[shard.centres[n]]], axis=1)
    pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
    some = np.flatnonzero(count)
    none = [None] * len(pairs)
    columns = [
        pa.array([*vec[some].tolist(), *none], pa.int64()), pa.array([*count[some].tolist(), *none], pa.int64()),
        pa.array([None] * len(some) + pairs[:, 0].tolist(), pa.int64()), pa.array([None] * len(some) + pairs[:, 1].tolist(), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["vec", "n", "a", "b"])
