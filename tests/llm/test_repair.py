"""Conversation repair against an exhaustive search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest

from gristmill.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(turns: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Least cost and audit of ``(initial, forced, truncated)`` turns, by all edits from every state."""

    @cache
    def best(i: int, after: str) -> tuple[int, str]:
        found = [(0, "")] if i == len(turns) and after in ("", "a") else []
        due = "a" if after == "u" else "u"
        # Two inserted turns in a row are never undone by more.
        if len(after) < 3:
            found += [(c + 2, "I" + e) for c, e in [best_inserted(i, due, 1)]]
        if i < len(turns):
            initial, forced, cut = turns[i]
            c, e = best(i + 1, after)
            found.append((c + 3, "D" + e))
            if not forced:
                if initial == due or (initial == "s" and after == ""):
                    c, e = best(i + 1, initial)
                    found.append((c + cut, "K" + e))
                c, e = best(i + 1, due)
                found.append((c + 2 + cut, "R" + e))
        return min(found)

    @cache
    def best_inserted(i: int, after: str, depth: int) -> tuple[int, str]:
        found = [(0, "")] if i == len(turns) and after == "a" else []
        due = "a" if after == "u" else "u"
        if depth < 3:
            found += [(c + 2, "I" + e) for c, e in [best_inserted(i, due, depth + 1)]]
        if i < len(turns):
            initial, forced, cut = turns[i]
            c, e = best(i + 1, after)
            found.append((c + 3, "D" + e))
            if not forced:
                c, e = best(i + 1, due)
                found.append((c + cut, "K" + e) if initial == due else (c + 2 + cut, "R" + e))
        return min(found, default=(10**9, ""))

    return best(0, "")


def code(initial: str, forced: bool, cut: bool) -> int:
    return {"s": 1, "u": 2, "a": 3}.get(initial, 0) | (4 if forced else 8 if cut else 0)


@pytest.mark.parametrize("kept", [512, 3])
def test_audits_equal_exhaustive_search(monkeypatch, kept):
    monkeypatch.setattr(repair, "KEPT", kept)
    draw = random.Random(5)
    for _ in range(1500):
        letters = draw.choice(["ua", "sua", "suax", "u", "x", "sx"])
        turns = [(draw.choice(letters), draw.random() < 0.2, draw.random() < 0.3) for _ in range(draw.randint(0, 9))]
        turns = [(c, f, cut and not f) for c, f, cut in turns]
        codes = np.array([code(*t) for t in turns], np.uint8)
        assert repair.audit_of(codes) == cheapest(turns), turns


def test_audit_gives_the_grammar_on_long_conversations():
    draw = random.Random(6)
    turns = [(draw.choice("suaaux"), draw.random() < 0.1, False) for _ in range(3000)]
    cost, audit = repair.audit_of(np.array([code(*t) for t in turns], np.uint8))
    made, rest, total = "", iter(turns), 0
    for edit in audit:
        initial, forced, _ = next(rest) if edit != "I" else ("", False, False)
        total += {"K": 0, "R": 2, "D": 3, "I": 2}[edit]
        assert edit == "D" or not forced
        if edit != "D":
            made += initial if edit == "K" else "a" if made.endswith("u") else "u"
    assert re.fullmatch("(s?(ua)+)?", made) and total == cost and next(rest, None) is None


def test_many_ties_stay_cheap():
    """Truncated turns of unknown roles tie between two edits each, so many lengths stay in the band."""
    codes = np.full(1200, code("x", False, True), np.uint8)
    cost, audit = repair.audit_of(codes)
    assert (cost, audit) == (3600, "D" * 1200)


def expected(rows: list[tuple]) -> dict:
    """Brute-force repair of rows ``(conv_id, turn, role, text)``."""
    conversations: dict = {}
    for conv, turn, role, text in rows:
        conversations.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    result = {}
    for conv, turns in conversations.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, facts, counts = set(), [], [0, 0, 0]
        for _, role, text in turns:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            facts.append((role[:1], fault in (0, 1), fault == 2))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(facts, facts[1:], strict=False))
        cost, audit = cheapest(facts)
        lines, rest, after = [], iter(turns), ""
        for edit in audit:
            _, role, text = next(rest) if edit != "I" else (None, "", "")
            if edit != "D":
                role = role if edit == "K" else "assistant" if after == "u" else "user"
                after = role[0]
                lines.append(f"{role}:{text}")
        result[conv] = (len(turns), gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def drawn_rows(seed: int) -> list[tuple]:
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, ""]
    texts = ["Yes.", "No", "", " \t", None, "Why?\n", "Why? \x0b", "a!b", "é", "Yes. "]
    rows = []
    for conv in [*range(60), None]:
        for k in range(draw.randint(1, 8)):
            rows.append((conv, draw.choice([k, k, k + 2, None]), draw.choice(roles), draw.choice(texts)))
    return rows + rows[:7]


def test_repair_equals_brute_force(spark):
    rows = drawn_rows(1)
    found, _ = repair.repair(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", cost int, audit string"))
    assert {r.conv_id: tuple(r)[1:] for r in found.collect()} == expected(rows)


def test_damage_follows_its_rule(spark):
    rows = drawn_rows(2)
    want = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        want += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    found = [tuple(r) for r in repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_empty_table_and_one_long_conversation(spark):
    empty, _ = repair.repair(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == []
    rows = [(1, k, "user" if k % 2 else "assistant", f"Turn {k}.") for k in range(5000)]
    found, _ = repair.repair(spark.createDataFrame(rows, SCHEMA))
    (row,) = found.collect()
    # The first turn is the assistant's, the last the user's.
    assert (row.n_turns, row.cost, row.illegal) == (5000, 4, 0)
    assert row.audit == "I" + "K" * 5000 + "I"
