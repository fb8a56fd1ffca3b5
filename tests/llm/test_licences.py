from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from gristmill.llm.licences import TEMPLATES, THRESHOLD, scan, terms_of

SCHEMA = "path string, text string, tag int"


def brute_own(files):
    units = [[terms_of(line) for line in (text or "").encode().split(b"\n")] for _, text, _ in files]
    lines = [Counter(line) for own in units for line in own if line]
    rows = [(name, Counter(terms_of(w.encode()))) for name, wordings in TEMPLATES.items() for w in wordings]
    known = {t for _, row in rows for t in row}
    idf = {t: math.log((len(lines) + 1) / (sum(t in line for line in lines) + 1)) + 1 for t in known}
    unseen = math.log((len(lines) + 1) / 2) + 1

    def cosine(a, b):
        dot = sum(n * idf[t] * b[t] * idf[t] for t, n in a.items() if t in known)
        length = math.sqrt(sum((n * idf[t]) ** 2 if t in known else n * unseen**2 for t, n in a.items()))
        return dot / length / math.sqrt(sum((n * idf[t]) ** 2 for t, n in b.items())) if length else 0

    out = {}
    for (path, _, tag), own in zip(files, units):
        whole = Counter(t for line in own for t in line)
        best = (0, None)
        for name, row in rows:
            score = max(cosine(u, row) for u in [*map(Counter, own), whole])
            if score > best[0] + 1e-12:
                best = (score, name)
        out[tag] = best if best[0] >= THRESHOLD else (None, None)
    return out


def brute(files):
    own = brute_own(files)
    notices = {}
    for path, _, tag in files:
        if path and path.rsplit("/", 1)[-1].upper().startswith(("LICENSE", "COPYING")) and own[tag][1]:
            folder = path.rsplit("/", 1)[0] if "/" in path else ""
            notices.setdefault(folder, []).append((-own[tag][0], own[tag][1]))
    out = {}
    for path, _, tag in files:
        licence, source = own[tag][1], None
        if not licence and path:
            folder = path.rsplit("/", 1)[0] if "/" in path else ""
            while folder not in notices and folder:
                folder = folder.rsplit("/", 1)[0] if "/" in folder else ""
            if folder in notices:
                licence, source = min(notices[folder])[1], folder
        out[tag] = (own[tag][1], licence, source)
    return out


def files():
    draw = random.Random(12)
    wordings = [w for ws in TEMPLATES.values() for w in ws]
    words = ["the", "of", "this", "work", "alpha", "beta", "gamma", "delta", "license"]
    out = []
    for tag in range(120):
        lines = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 12))) for _ in range(draw.randint(0, 5))]
        if draw.random() < 0.3:
            lines.insert(draw.randint(0, len(lines)), draw.choice(wordings))
        folder = "/".join(draw.choice("abc") for _ in range(draw.randint(0, 4)))
        name = draw.choice(["LICENSE", "COPYING.txt", "x.py", "y.py", "z.py"])
        out.append((f"{folder}/{name}" if folder else name, "\n".join(lines), tag))
    return out + [(None, wordings[0], 900), (None, None, 901), ("a/x", "", 902), ("a/x", "", 903)]


def test_matches_brute_force(spark):
    rows = files()
    found, _ = scan(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert {r.tag: (r.own_licence, r.licence, r.inherited_from) for r in found.collect()} == brute(rows)


@pytest.mark.parametrize("name", ["MIT", "CC-BY-NC-4.0", "proprietary"])
def test_every_wording_is_found_in_a_file(spark, name):
    rows = [("p/x", f"alpha beta\n  {TEMPLATES[name][0].upper()}\ngamma", 1), ("p/LICENSE", " ".join(TEMPLATES[name]), 2), ("p/q/r", "alpha", 3)]
    found = {r.tag: (r.own_licence, r.licence, r.inherited_from) for r in scan(spark.createDataFrame(rows, SCHEMA))[0].collect()}
    assert found == {1: (name, name, None), 2: (name, name, None), 3: (None, name, "p")}


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], SCHEMA))[0].count() == 0


def test_columns_of_any_name_and_repeated_rows(spark):
    rows = [("a/LICENSE", "SPDX-License-Identifier: MIT", "x", 1, "d"), ("a/b", "plain", "y", 2, "e"), ("a/b", "plain", "y", 2, "e")]
    files = spark.createDataFrame(rows, "path string, text string, own_licence string, __dir int, licence string")
    found, _ = scan(files)
    assert found.columns == ["path", "__dir", "own_licence", "own_score", "licence", "inherited_from"]
    assert sorted((r.path, r["__dir"]) for r in found.collect()) == [("a/LICENSE", 1), ("a/b", 2), ("a/b", 2)]
