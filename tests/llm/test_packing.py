from __future__ import annotations

import functools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gristmill.llm.packing import Demands, Limits, WordTokens, fill_bin, pack_examples, pack_texts, powers_of_two, tokenized

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"


@functools.cache
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def plain_ids(text):
    return plain().encode(text or "", add_special_tokens=False).ids + [1]


def own(words, text):
    return next(tokenized(pa.array([text], pa.string()), words, 1)).tolist()


@pytest.fixture(scope="module")
def words():
    return WordTokens(PATH)


@given(st.text(alphabet=st.sampled_from("aBé ß\n\t ́.'s0<|endoftext|>漢 \x1c\x0bİΣ"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_word_ids_are_the_text_ids(words, text):
    assert own(words, text) == plain_ids(text)


@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_word_ids_of_any_characters(words, text):
    assert own(words, text) == plain_ids(text)


def test_word_ids_of_given_texts(words):
    import pyarrow.parquet as pq

    for text in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist():
        assert own(words, text) == plain_ids(text)


def check(rows, pieces, limit=2048, segments=256):
    own = {i: plain_ids(t) for i, t in rows}
    spans, sequences = {}, {}
    for p in pieces:
        ids = own[p.doc_id][p.start : p.start + p.length]
        assert len(ids) == p.length > 0 and p.doc_tokens == len(own[p.doc_id])
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == p.ids_crc32
        spans.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(spans) == set(own)
    for i, found in spans.items():
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == len(own[i])
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at == limit or at & (at - 1) == 0
        assert at <= limit and len(found) <= segments


def test_every_id_once_and_no_padding(spark):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choice(["the", "thndhain", "été.", "IN!!"]) for _ in range(draw.choice([0, 5, 90, 900, 4000])))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "  ")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    check(rows, pack_texts(df, PATH).collect())
    check(rows, pack_texts(df, PATH, limits=Limits(2048, 4, 2048)).collect(), segments=4)
    check(rows, pack_texts(df, PATH, limits=Limits(2048, 9, 512)).collect(), limit=512, segments=9)


def test_empty_and_rows_without_id(spark):
    assert pack_texts(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    rows = pack_texts(spark.createDataFrame([(None, "a b"), (3, "a"), (3, "a")], SCHEMA).coalesce(1), PATH).collect()
    assert sorted((r.doc_id is None, r.doc_tokens) for r in rows if r.start == 0) == [(False, 2), (False, 2), (True, 3)]


def test_examples_keep_every_limit(spark):
    draw = random.Random(4)
    rows = [(i, draw.randint(0, 900), draw.randint(0, 300)) for i in range(400)] + [(999, 5000, 1), (1000, None, None)]
    limits = Limits(2048, 6, 700)
    df = spark.createDataFrame(rows, "id long, t long, l long").coalesce(2)
    placed = pack_examples(df, "id", "t", "l", limits).collect()
    assert sorted(r.id for r in placed) == sorted(r[0] for r in rows)
    demand = {i: (t or 0, l or 0) for i, t, l in rows}
    bins = {}
    for r in placed:
        if r.id == 999:
            assert r.sequence_id is None
            continue
        bins.setdefault(r.sequence_id, []).append((r.offset, *demand[r.id]))
    for found in bins.values():
        assert sum(t for _, t, _ in found) <= 2048 and len(found) <= 6 and sum(l for _, _, l in found) <= 700
        assert sorted(o for o, _, _ in found)[0] == 0
    least = max(sum(d[0] for i, d in demand.items() if i != 999) / 2048, sum(d[1] for d in demand.values()) / 700)
    assert len(bins) <= 1.25 * least + 2


def test_dot_product_prefers_what_is_plenty():
    demands = np.array([[8.0, 1.0], [1.0, 8.0], [4.0, 4.0]])
    assert fill_bin(demands, np.array([20.0, 9.0]), np.ones(3, bool))[0] == 1
    assert powers_of_two(1500) == [1024, 256, 128, 64, 16, 8, 4]


def greedy(demands, capacity):
    """The rows of each bin by looking at every open row again and again."""
    still, bins = list(range(len(demands))), []
    while still:
        room, chosen = capacity.copy(), []
        while fits := [k for k in still if (demands[k] <= room).all()]:
            best = max(fits, key=lambda k: ((demands[k] / capacity) @ (room / capacity), -k))
            chosen.append(best)
            still.remove(best)
            room = room - demands[best]
        bins.append(chosen)
    return bins


def test_kinds_of_demands_fill_the_same_bins():
    draw = random.Random(3)
    capacity = np.array([64.0, 8.0, 32.0])
    for most in (2, 16, 32):
        demands = np.array([[draw.randint(1, most), 1, draw.randint(0, most)] for _ in range(90)], np.float64)
        pool, bins = Demands(demands, capacity), []
        while pool.size:
            bins.append(pool.fill())
        assert bins == greedy(demands, capacity)


def test_many_short_texts_in_one_task(spark):
    rows = spark.range(200_000, numPartitions=1).selectExpr("id AS doc_id", "if(id % 3 = 0, 'a', '') AS text")
    found = pack_texts(rows, PATH)
    by = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("pieces"))
    total = by.agg(F.sum("n"), F.max("pieces"), F.sum(F.expr("n & (n - 1)"))).first()
    assert tuple(total) == (266_667, 256, 0)
    assert found.select("doc_id").distinct().count() == 200_000
