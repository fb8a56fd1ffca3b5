from __future__ import annotations

import random

import numpy as np
import pytest

from gristmill.llm.components import components
from gristmill.llm.nearcopies import _factors, _leaders, least_matches, near_copies, signature, sketch
from gristmill.session import Scope

SCHEMA = "doc_id long, text string"


def brute(rows, n=4, percent=80):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[p : p + n]) for p in range(max(1, len(words) - n + 1))} if words else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus(seed, size=160):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    bases = [[draw.choice(words) for _ in range(draw.choice([3, 8, 60, 150]))] for _ in range(8)]
    rows = []
    for i in range(size):
        text = list(draw.choice(bases)) if i % 3 else [draw.choice(words) for _ in range(draw.randint(0, 80))]
        for _ in range(draw.choice([0, 0, 1, 2, 3, 5])):
            if text:
                text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((i * 13 % 997, " ".join(text)))
    return rows + [(2000, None), (2001, " \n"), (2002, "One two"), (2003, "one TWO"), (2004, "one two three four")]


def found(df):
    return {r.id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(near_copies(df, shingle=4)[0]) == brute(rows)


def test_chain_reaches_the_smallest(spark):
    words = [f"a{i}" for i in range(100)]
    rows = [(10 - k, " ".join(words[2 * k : 2 * k + 60])) for k in range(10)]
    assert found(near_copies(spark.createDataFrame(rows, SCHEMA), shingle=4)[0]) == brute(rows)
    assert len({c for _, c, _ in brute(rows).values()}) == 1


def test_edge_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_copies(empty)[0].count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (5, text), (5, text), (7, "x y z q r s"), (7, text)]
    out = sorted((r.id, r.component_id) for r in near_copies(spark.createDataFrame(rows, SCHEMA))[0].collect())
    assert out == [(5, 5), (5, 5), (7, 5), (7, 5)]


def test_signatures_agree_as_often_as_the_sets():
    draw, factors = np.random.default_rng(3), _factors(64)
    agreed = []
    for _ in range(2000):
        both = draw.integers(0, 2**63, 12).astype(np.uint64)
        a, b = both[:11], np.append(both[:10], both[11])
        agreed.append((signature(a, factors) == signature(b, factors)).sum())
    mean = 64 * 10 / 12
    assert abs(np.mean(agreed) - mean) < 0.5
    assert np.std(agreed) < 1.25 * np.sqrt(64 * 10 / 12 * 2 / 12)
    assert least_matches(64, 0.8) < min(agreed)


def test_components_of_a_long_path(spark):
    links = spark.range(60).selectExpr("(id * 7) % 61 as i", "((id + 1) * 7) % 61 as j")
    with Scope(spark) as scope:
        assert {tuple(r) for r in components(links, scope).collect()} == {(i, 0) for i in range(61)}


def test_components_of_mixed_links(spark):
    draw = random.Random(5)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(7, 7), (400, 3), (400, 3)]
    label = {i: i for pair in links if pair[0] != pair[1] for i in pair}
    for _ in label:
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    with Scope(spark) as scope:
        rows = components(spark.createDataFrame(links, "i long, j long"), scope).collect()
    assert len(rows) == len(label) and {r.id: r.component for r in rows} == label


@pytest.mark.parametrize("size", [1000, 4000])
def test_pairs_of_a_family_follow_its_members(spark, monkeypatch, size):
    draw = random.Random(size)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(f"x{i}" if k in at else w for k, w in enumerate(base))) for i in range(size) for at in [draw.sample(range(120), 2)]]
    stage, pairs = Scope.stage, []

    def counted(scope, df, name):
        table = stage(scope, df, name)
        if name == "pairs":
            pairs.append(table.count())
        return table

    monkeypatch.setattr(Scope, "stage", counted)
    out = near_copies(spark.createDataFrame(rows, SCHEMA), shingle=4)[0].collect()
    assert {r.component_id for r in out} == {0}
    assert sum(pairs) <= 4 * size


def test_leaders_of_two_large_components(spark):
    rows = [(1, rep, 9, rep % 7, rep % 2) for rep in range(1000)] + [(2, rep, 9, 1, 5 + rep) for rep in range(40)]
    posted = spark.createDataFrame(rows, "token long, rep long, n int, shared int, component long")
    one = {tuple(r) for r in _leaders(posted, 256).select("token", "rep").collect()}
    assert one == {(1, 6), (1, 13)} | {(2, rep) for rep in range(40)}
    many = _leaders(posted, 4096, 16).groupBy("token", "component").count().collect()
    assert sorted((r.token, r["count"]) for r in many) == [(1, 16), (1, 16)] + [(2, 1)] * 40
    assert _leaders(posted, 16, 16).groupBy("token").count().agg({"count": "max"}).first()[0] == 16


def test_texts_just_below_the_threshold_to_a_family_are_told_by_sketches(spark, monkeypatch):
    """Outsiders share enough shingles to stay open, so each meets every member; the meetings are no pairs to verify."""
    draw = random.Random(8)
    base = [f"b{i}" for i in range(120)]

    def changed(i, many, first):
        at = draw.sample(range(first, 116, 8), many)
        return i, " ".join(f"x{i}" if k in at else w for k, w in enumerate(base))

    rows = [changed(i, 1, 4) for i in range(200)] + [changed(1000 + i, 3, 8) for i in range(40)]
    stage, pairs = Scope.stage, []

    def counted(scope, df, name):
        table = stage(scope, df, name)
        if name == "pairs":
            pairs.append(table.count())
        return table

    monkeypatch.setattr(Scope, "stage", counted)
    assert found(near_copies(spark.createDataFrame(rows, SCHEMA), shingle=4)[0]) == brute(rows)
    assert sum(pairs) <= 8 * len(rows)


def test_sketches_differ_in_no_more_bins_than_the_sets():
    draw = np.random.default_rng(9)
    for size in (1, 30, 400, 3000):
        both = draw.integers(0, 2**63, 2 * size).astype(np.uint64)
        a, b = both[: size + size // 2], both[size // 2 :]
        apart = sum((int(x) ^ int(y)).bit_count() for x, y in zip(sketch(a).view(np.uint64), sketch(b).view(np.uint64), strict=True))
        assert apart <= size and (apart - size) % 2 == 0
