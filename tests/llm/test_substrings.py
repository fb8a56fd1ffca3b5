from __future__ import annotations

import hashlib
import random

from gristmill.llm.substrings import remove_repeats

SCHEMA = "doc_id long, text string"


def brute(rows, window=20):
    split = sorted(((i, (t or "").encode().split()) for i, t in rows), key=lambda x: x[0])
    seen, out = set(), {}
    for i, words in split:
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def corpus():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    passage = [draw.choice(words) for _ in range(60)]
    short = [draw.choice(words) for _ in range(20)]
    rows = []
    for i in range(150):
        text = [draw.choice(words) for _ in range(draw.randint(0, 120))]
        kind = i % 6
        at = draw.randint(0, len(text))
        if kind == 0:
            text[at:at] = passage[draw.randint(0, 30) :]
        elif kind == 1:
            text[at:at] = short
        elif kind == 2:
            text[at:at] = short[:19]
        elif kind == 3 and rows:
            text = draw.choice(rows)[1].split()
        elif kind == 4:
            text[at:at] = ["The"] * draw.randint(10, 70)
        rows.append((i * 7 % 1009, " ".join(text)))
    rows += [(5000, None), (5001, ""), (5002, "x y " * 60), (5003, "a\tb\n" * 11), (-4, rows[0][1])]
    draw.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(remove_repeats(df)) == brute(rows)


def test_rows_without_id_and_extra_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame(
        [(1, text, "a"), (None, text, "b"), (2, text, None), (2, text, "c")],
        "doc_id long, text string, id string",
    )
    out = {(r.doc_id, r.id): (r.n_removed, r.kept_text) for r in remove_repeats(df).collect()}
    assert out == {(1, "a"): (0, text), (None, "b"): (0, text), (2, None): (40, ""), (2, "c"): (40, "")}


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0



def test_columns_of_any_name(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text, 5, "a", 6), (2, text + " tail", 7, "b", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_removed int, `odd name` string, __id int")
    found = {r.doc_id: r for r in remove_repeats(df).collect()}
    assert (found[1].n_removed, found[2].n_removed, found[2].kept_text) == (0, 40, "tail")
    assert (found[2]["odd name"], found[2]["__id"], found[2].text) == ("b", 8, text + " tail")
