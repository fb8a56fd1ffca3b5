import random

from pyspark.sql import functions as F

from gristmill.operators import indexing
from gristmill.operators.indexing import dense_index, first_k, rank_in_group
from gristmill.operators.links import children_of


def test_first_k_on_uneven_keys(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice([5, 5, 5, -7, 2**62, -(2**62), rng.randrange(1000)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    for buckets in (4, 4096):
        monkeypatch.setattr(indexing, "BUCKETS", buckets)
        for k in (0, 1, 700, 1500, 2999, 3000, 5000):
            got = [tuple(r) for r in df.filter(first_k(df, ["a", "b"], k)).collect()]
            assert sorted(got) == sorted(rows)[:k]


def test_dense_index(spark, monkeypatch):
    keys = [10**12] + [i * i for i in range(35_000)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    got = [tuple(r) for r in dense_index(df, "k").orderBy("k").select("k", "_idx").collect()]
    assert got == [(k, i) for i, k in enumerate(sorted(keys))]


def test_rank_in_group_with_a_hot_group(spark):
    rows = [(i, None if i % 10 == 0 else "hot" if i % 3 else f"g{i % 7}") for i in range(2000)]
    df = spark.createDataFrame(rows, "_idx bigint, g string")
    got = rank_in_group(df, "g", "_idx", 50, "rank").collect()
    seen = {}
    for r in sorted(got, key=lambda r: r["_idx"]):
        assert r["rank"] == seen.get(r["g"], 0)
        seen[r["g"]] = seen.get(r["g"], 0) + 1
    assert len(got) == 2000


def test_offsets_over_several_runs(spark, monkeypatch):
    monkeypatch.setattr(indexing, "BUCKETS", 4)
    totals = spark.createDataFrame([(b, b * b + 1) for b in range(0, 60, 2)], "b bigint, n bigint").repartition(3)
    got = {r["b"]: r["offset"] for r in indexing.running_offsets(totals, "b", "n", "offset").collect()}
    assert got == {b: sum(c * c + 1 for c in range(0, b, 2)) for b in range(0, 60, 2)}


def test_children_are_dense(spark):
    parents = spark.range(10_000).toDF("_idx")
    for low, high in ((0, 3), (2, 2), (0, 0)):
        made = children_of(parents.repartition(7), "_idx", 10_000, low, high, 1, "kids", ["_idx"])
        made = made.toDF("parent", "child", "row")
        rows = made.orderBy("row").collect()
        assert [r["row"] for r in rows] == list(range(len(rows)))
        assert [(r["parent"], r["child"]) for r in rows] == sorted((r["parent"], r["child"]) for r in rows)
        per = made.groupBy("parent").agg(F.count("*").alias("n"))
        assert all(low <= r["n"] <= high for r in per.collect())
