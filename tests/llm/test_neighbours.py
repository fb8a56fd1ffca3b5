from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gristmill.llm import neighbours
from gristmill.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, vectors, k=10):
    out = {}
    for q, vector in zip(ids, vectors):
        if q % 100 == 0:
            d = np.sqrt(((vectors - vector) ** 2).sum(axis=1))
            order = [o for o in np.lexsort((ids, d)) if ids[o] != q][:k]
            out[q] = [(r + 1, ids[o], d[o]) for r, o in enumerate(order)]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(rows) for q, rows in out.items()}


def clusters(n, size=32):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(20, size))
    vectors = (centres[draw.integers(0, 20, n)] + 0.8 * draw.normal(size=(n, size))).astype(np.float32)
    return np.arange(n), vectors.astype(np.float64)


def frame(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], SCHEMA).repartition(4)


def test_recall_and_exact_scores(spark):
    ids, vectors = clusters(6000)
    out = found(nearest(frame(spark, ids, vectors), F.col("id") % 100 == 0, share=0.2, least_search=0)[0])
    truth = brute(ids, vectors)
    assert set(out) == set(truth)
    recall = np.mean([len({v for _, v, _ in out[q]} & {v for _, v, _ in truth[q]}) / 10 for q in truth])
    assert recall >= 0.9
    for q, rows in out.items():
        assert [r for r, _, _ in rows] == list(range(1, 11))
        for _, v, score in rows:
            assert score == np.sqrt(((vectors[v] - vectors[q]) ** 2).sum())


def test_everything_searched_is_exact_with_ties_and_blocks(spark, monkeypatch):
    ids, vectors = clusters(700, 6)
    vectors[100:400] = vectors[100]  # a hot vector
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 2)
    out = found(nearest(frame(spark, ids, vectors), F.col("id") % 100 == 0, share=1e6)[0])
    truth = brute(ids, vectors)
    assert {q: [(r, v) for r, v, _ in rows] for q, rows in out.items()} == {q: [(r, v) for r, v, _ in rows] for q, rows in truth.items()}


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (100, [0.0, 0.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]), (9, [])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("clash")).withColumn("score", F.lit(1))
    assert {q: [v for _, v, _ in r] for q, r in found(nearest(df, F.col("id") % 100 == 0)[0]).items()} == {0: [8, 1]}
    assert nearest(spark.createDataFrame([], SCHEMA), F.col("id") % 100 == 0)[0].count() == 0


def test_leaves_depend_on_the_sample_alone(spark):
    ids, vectors = clusters(3000)
    a = found(nearest(frame(spark, ids, vectors), F.col("id") % 100 == 0, sample=500, share=0.1, least_search=100)[0])
    b = found(nearest(frame(spark, ids, vectors).coalesce(1), F.col("id") % 100 == 0, sample=500, share=0.1, least_search=100)[0])
    assert a == b


def test_a_hot_short_vector_takes_nothing_from_the_search(spark):
    draw = np.random.default_rng(9)
    vectors = draw.normal(size=(21_000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[7_000:14_000] = 0.3 * vectors[7_000]
    vectors, ids = vectors.astype(np.float32).astype(np.float64), np.arange(21_000)
    asked = (F.col("id") % 100 == 0) & ((F.col("id") < 7_000) | (F.col("id") == 8_000))
    out = found(nearest(frame(spark, ids, vectors), asked)[0])
    truth = {q: rows for q, rows in brute(ids, vectors).items() if q in out}
    assert len(out) == 71 and [v for _, v, _ in out[8_000]] == list(range(7_000, 7_010))
    recall = [len({v for _, v, _ in out[q]} & {v for _, v, _ in truth[q]}) / 10 for q in truth if q < 7_000]
    assert np.mean(recall) >= 0.9


def test_batches_stay_small_however_many_leaves_a_query_visits():
    queries, leaves = 300, 2_000
    ids, visited = np.arange(queries), np.arange(leaves, dtype=np.int32)
    vectors, none = pa.array([[float(i)] * 64 for i in ids], pa.list_(pa.float32())), pa.nulls(queries, pa.list_(pa.int64()))
    lists = neighbours._leaf_lists([visited] * queries)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), vectors, none, lists], ["id", "vector", "ids", "leaves"])
    row_blocks, query_blocks = np.ones(leaves, np.int64), np.ones(leaves, np.int64)
    row_blocks[7], query_blocks[9] = 3, 2
    met = []
    for out in neighbours._dealt(iter([batch]), row_blocks, query_blocks, True):
        assert out.num_rows <= 10_000 and out.nbytes < 4_000_000
        met += zip(*(out.column(c).to_pylist() for c in ("leaf", "block", "part", "id")))
        assert out.column("vector")[0].as_py()[0] == out.column("id")[0].as_py()
    part = lambda q, n: abs((q * 2654435761) >> 7) % n
    wanted = [(v, b, part(q, int(query_blocks[v])), q) for q in range(queries) for v in range(leaves) for b in range(row_blocks[v])]
    assert sorted(met) == sorted(wanted)
    whole = neighbours.Forest([neighbours._one_leaf()] * 3)
    routed = list(neighbours._routed(iter([batch.select([0, 1])]), whole, np.array([5, 0, 5]), 10, 1))
    assert [b.num_rows for b in routed] == [256, 44] and routed[1].column("leaves").to_pylist() == [[0, 2]] * 44
