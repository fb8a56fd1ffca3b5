"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from gristmill.llm import spelling

SCHEMA = "doc_id long, text string, n_near int, word string"


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected_variants(counts: dict[str, int], ratio: int = 10) -> set[tuple]:
    forms, sizes = {}, {}
    for word, n in counts.items():
        found = [other for other in counts if near(word, other)]
        sizes[word] = len(found)
        best = min(found, key=lambda other: (-counts[other], other), default=None)
        forms[word] = best if best is not None and counts[best] >= ratio * n else None
    rows = set()
    for word, n in counts.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        rows.add((word, forms[word], root, n, sizes[word], counts.get(forms[word])))
    return rows


def expected_counts(docs: list[tuple], damaged: bool) -> dict[str, int]:
    found: Counter[str] = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for id_, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if damaged and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {word: n for word, n in found.items() if len(word) >= 7 and n >= 2}


def made_words(seed: int, size: int, letters: str = "abé") -> dict[str, int]:
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(7, 10))) for _ in range(size)}
    return {word: draw.choice([2, 3, 20, 25, 300, 4000]) for word in words}


@pytest.mark.parametrize("tile", [2048, 7])
def test_variants_equal_all_pairs(spark, tile):
    counts = made_words(1, 400) | {"zzzzzzzzzzzz": 2, "ÿÿÿÿÿÿÿ": 5}
    found, _ = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), tile=tile)
    assert {tuple(r) for r in found.collect()} == expected_variants(counts)


def test_chains_of_forms(spark):
    words = [("a" * k + "b" * (9 - k), 11**k * 2) for k in range(9)]
    found, _ = spelling.variants(spark.createDataFrame(words, "word string, n long"))
    found = {r.word: r for r in found.collect()}
    assert {r.root for r in found.values()} == {"aaaaaaaab"}
    assert found["bbbbbbbbb"].form == "abbbbbbbb" and found["aaaaaaaab"].form is None


def test_one_hot_half_is_dealt(spark):
    """Words that all share their first half meet in several tiles; the result is the same."""
    draw = random.Random(3)
    words = {"common" + "".join(draw.choice("abcd") for _ in range(draw.randint(5, 6))): 2 for _ in range(900)}
    words["commonaaaaa"] = 50
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    small, _ = spelling.variants(table, tile=64)
    whole, _ = spelling.variants(table)
    assert {tuple(r) for r in small.collect()} == {tuple(r) for r in whole.collect()} == expected_variants(words)


def test_counts_with_nulls_clashing_columns_and_repeated_rows(spark):
    docs = [
        (1, "Kitchen kitchen, KITCHEN! kitchens"), (1, "Kitchen kitchen, KITCHEN! kitchens"), (2, None), (3, ""),
        (None, "naïveté·naïveté×über-größere größere ÉCOLE-Écoles €€ 日本語 naïvetés"), (4, "x" * 5000 + " " + "x" * 5000),
    ]
    docs += [(k, "kitchen garden gardens meadows") for k in range(10, 80)]
    table = spark.createDataFrame([(*d, 5, "w") for d in docs], SCHEMA)
    for damage in (None, spelling.shorten):
        found = spelling.word_counts(table, damage=damage)
        assert {r.word: r.n for r in found.collect()} == expected_counts(docs, damage is not None)


def test_long_texts_are_split_at_blanks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 10)
    words = [w for part in spelling.runs(("alphabet " * 50 + "é" * 40 + "€gamma").encode()) for w in part]
    assert words == [b"alphabet"] * 50 + ["é".encode() * 40, b"gamma"]


def test_empty_table_and_repeated_words(spark):
    empty, _ = spelling.variants(spark.createDataFrame([], "word string, n long"))
    assert empty.collect() == []
    assert spelling.word_counts(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [("windows", 2), ("windows", 3), (None, 9), ("window", 70)]
    found, _ = spelling.variants(spark.createDataFrame(rows, "word string, n long"))
    assert {tuple(r) for r in found.collect()} == {("windows", "window", "window", 5, 1, 70), ("window", None, "window", 70, 1, None)}


def test_too_small_ratio_is_refused(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), ratio=1)
