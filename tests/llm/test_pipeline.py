"""The pipeline against the operators' brute-force versions, stage by stage."""

from __future__ import annotations

import random

import test_decontam
import test_nearcopies
import test_packing
import test_substrings

from gristmill.llm import pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def tables():
    draw = random.Random(21)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("nd", "ng", "st")]
    passage = [draw.choice(words) for _ in range(60)]
    items = [(i, " ".join(draw.choice(words) for _ in range(25))) for i in range(4)]
    texts = []
    for i in range(90):
        text = [draw.choice(words) for _ in range(draw.randint(1, 150))]
        if i % 9 == 3:
            text[5:5] = passage
        elif i % 9 == 5:
            text = items[i % 4][1].split() + text[:40]
        elif i % 9 == 7 and texts:
            text = draw.choice(texts).split()
            text[len(text) // 2] = "changed"
        texts.append(" ".join(text))
    texts += [None, "", "12 34 !!", texts[0], "\n".join(texts[1].split())]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], items


def expected(rows, items):
    """The documents that reach packing."""
    kept = [(i, t) for i, t, *_ in rows if t and any(map(str.isalpha, t))]
    near = test_nearcopies.brute(kept, n=5)
    kept = [(i, t) for i, t in kept if near[i][2]]
    removed = test_substrings.brute(kept)
    seen, changed = set(), []
    for i, t in sorted(kept):
        words = t.encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - 19):
            key = tuple(words[p : p + 20])
            if key in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(key)
        assert sum(gone) == removed[i][1]
        changed.append((i, b" ".join(w for w, g in zip(words, gone) if not g).decode() if any(gone) else t))
    hit = {row[0]: row for row in test_decontam.brute(changed, items)}
    return [(i, t) for i, t in changed if not (hit[i][2] and 20 * hit[i][2] >= hit[i][1])]


def write(spark, folder, rows, items):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_run_matches_brute_force(spark, tmp_path):
    rows, items = tables()
    write(spark, tmp_path, rows, items)
    kept = expected(rows, items)
    assert 30 < len(kept) < len(rows) - 15
    pieces = pipeline.run(spark, str(tmp_path)).collect()
    test_packing.check(kept, pieces)


def test_stages_keep_the_columns(spark, tmp_path):
    rows, items = tables()
    write(spark, tmp_path, rows[:20], items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).dtypes == docs.dtypes, name


def test_empty_documents(spark, tmp_path):
    write(spark, tmp_path, [], [(1, "a b c")])
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_documents_stay_if_no_language_can_be_learned(spark):
    rows = [(i, text, None, "s", 0) for i, text in enumerate(["some words", None, "", "12 34 !!", "\u00e9t\u00e9"])]
    kept = pipeline.language_id(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 4]


def test_columns_of_any_name_pass(spark, tmp_path):
    rows, items = tables()
    names = "score double, lang_pred string, kept_text string, n_removed long, __text string, __id long, row int, own_print long"
    wider = [(*r, 0.5, "x", "y", 7, "z", 8, 9, 10) for r in rows]
    spark.createDataFrame(wider, f"{SCHEMA}, {names}").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        found = stage(spark, docs, str(tmp_path))
        assert found.dtypes == docs.dtypes, name
        assert {tuple(r)[5:] for r in found.collect()} == {(0.5, "x", "y", 7, "z", 8, 9, 10)}
    test_packing.check(expected(rows, items), pipeline.run(spark, str(tmp_path)).collect())


def test_repeated_rows_leave_one(spark, tmp_path):
    rows, items = tables()
    write(spark, tmp_path, rows * 2, items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    alone = spark.createDataFrame(rows, SCHEMA)
    twice = sorted(tuple(r) for r in pipeline.near_dedup(spark, docs.filter("text is not null"), "").collect())
    once = sorted(tuple(r) for r in pipeline.near_dedup(spark, alone.filter("text is not null"), "").collect())
    assert twice == once
    test_packing.check(expected(rows, items), pipeline.run(spark, str(tmp_path)).collect())


def test_the_identified_language_takes_effect(spark, tmp_path):
    rows = [(i, " ".join(["the house and the garden", "le jardin et la maison"][i % 2].split()[k:] * 3), ["en", "fr"][i % 2], "s", 0) for k in range(3) for i in range(k * 40, k * 40 + 40)]
    rows += [(500, "the garden and the house", None, "s", 0), (501, "la maison et le jardin", "xx", "s", 0)]
    found = {r.doc_id: r.lang for r in pipeline.language_id(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert found[500] == "en" and len(found) == len(rows)
    assert sum(found[r[0]] == r[2] for r in rows) >= 118
