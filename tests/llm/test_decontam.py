from __future__ import annotations

import random
import re

import numpy as np

from gristmill.llm import decontam
from gristmill.llm.decontam import decontaminate, matches, phrases, proximity_matches, segments, term_counts

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for item, question in items:
            own = split(question)
            size = min(13, len(own))
            if item is None or not size:
                continue
            windows = {tuple(own[p : p + size]) for p in range(len(own) - size + 1)}
            for p in range(len(words) - size + 1):
                if tuple(words[p : p + size]) in windows:
                    hit |= set(range(p, p + size))
                    found.add(item)
        out.append((doc, len(words), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()), key=repr)


def tables():
    draw = random.Random(9)
    words = ["the", "of", "été", "Straße", "x2"] + [f"q{i}" for i in range(60)]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.choice([3, 13, 20, 30])))) for i in range(25)]
    items += [(90, None), (91, "..!"), (92, "q1"), (None, "the of"), (3, "the the the the")]
    docs = []
    for i in range(90):
        text = [draw.choice(words) for _ in range(draw.randint(0, 60))]
        source = draw.choice(items)[1]
        if i % 3 and source:
            cut = source.split()
            at = draw.randint(0, len(cut))
            text[draw.randint(0, len(text)) : 0] = [w.upper() if draw.random() < 0.3 and w.isascii() else w for w in cut[at // 2 :]]
        docs.append((i if i % 20 else None, (", " if i % 2 else "\n").join(text)))
    docs += [(200, None), (201, ""), (202, docs[4][1]), (202, docs[4][1])]
    return docs, items


def test_matches_brute_force_in_one_block_and_in_many(spark):
    docs, items = tables()
    df, bench = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    expected = brute(docs, items)
    assert found(matches(df, bench)[0]) == expected
    decontam.BLOCK_BYTES, before = 700, decontam.BLOCK_BYTES
    try:
        assert found(matches(df, bench)[0]) == expected
    finally:
        decontam.BLOCK_BYTES = before
    kept = sorted(((r.doc_id, r.text) for r in decontaminate(df, bench).collect()), key=repr)
    clean = [d for d in docs if not any(e[0] == d[0] and e[1] == len(split(d[1])) and 20 * e[2] >= e[1] and e[2] for e in brute([d], items))]
    assert kept == sorted(clean, key=repr)


def test_empty_tables(spark):
    none, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b c")], ITEMS)
    assert matches(none, bench)[0].count() == 0
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], DOCS)
    assert found(matches(docs, spark.createDataFrame([], ITEMS))[0]) == [(1, 3, 0, ()), (2, 0, 0, ())]
    extra = spark.createDataFrame([(1, "A b, c x", 5), (2, "x", 6)], "doc_id long, text string, id int")
    assert [tuple(r) for r in decontaminate(extra, bench).collect()] == [(2, "x", 6)]


def test_spans_and_proximity(spark):
    docs = spark.createDataFrame([(1, "z a b c z z a b c"), (2, "c z a z z z z z b")], DOCS).coalesce(1)
    bench = spark.createDataFrame([(7, "a b c")], ITEMS)
    rows = {r.id: (r.starts, r.ends) for r in matches(docs, bench)[0].collect()}
    assert rows == {1: ([1, 6], [4, 9]), 2: ([], [])}
    of = phrases([(7, "a b c")])
    index = segments(docs, "doc_id", "text", of.terms)
    counts = term_counts(index, len(of.terms))
    assert counts.tolist() == [3, 3, 3]
    near = {(r.id, r.item) for r in proximity_matches(index, of, np.array(counts), 6).collect()}
    assert near == {(1, 7), (2, 7)}
    assert {r.id for r in proximity_matches(index, of, np.array(counts), 2).collect()} == {1}
