from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gristmill.llm.chat import Template, format_conversations, loss_text, read_turns

SCHEMA = "conv_id long, turn long, role string, text string"


def formatted(spark, rows, **names):
    out = format_conversations(spark.createDataFrame(rows, SCHEMA), **names)
    return {r.conv_id: r for r in out.withColumns({"turns": read_turns(F.col("formatted")), "loss": loss_text(F.col("segments"))}).collect()}


def test_round_trip_of_any_text(spark):
    draw = random.Random(6)
    pieces = ["<", "|", "\\", "<|im_end|>", "<|im_start|>", "<\\|", "assistant", "\n", " ", "é漢", "ok", "%0A", "+"]
    rows = []
    for conv in range(60):
        for turn in range(draw.randint(1, 5)):
            text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 9)))
            role = draw.choice(["user", "assistant", "a b\n<|im_end|>", "", "système"])
            rows.append((conv, turn, role, text))
    found = formatted(spark, rows)
    for conv in range(60):
        own = [(r, t) for c, _, r, t in rows if c == conv]
        assert [(t.role, t.text) for t in found[conv].turns] == own
        assert found[conv].loss == "".join(t for r, t in own if r == "assistant")
        assert found[conv].formatted.count("<|im_start|>") == found[conv].formatted.count("<|im_end|>") == len(own)


def test_machine(spark):
    def errors(*talks):
        rows = [(c, k, role, "x") for c, talk in enumerate(talks) for k, role in enumerate(talk)]
        found = formatted(spark, rows)
        return [(found[c].valid, found[c].error_turn) for c in range(len(talks))]

    s, u, a = "system", "user", "assistant"
    assert errors([u, a], [s, u, a, u, a], [u], [a, u], [u, u, a], [u, a, s], [u, "tool", a]) == [
        (True, None), (True, None), (False, 1), (False, 0), (False, 1), (False, 2), (False, 1)]


def test_nulls_ties_and_extra_columns(spark):
    rows = [(1, 3, "user", None), (1, None, None, "first"), (1, 3, "user", None), (None, 0, "user", "lost"), (1, 9, "assistant", "z")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit(1)).withColumn("row", F.lit(2))
    found = format_conversations(df).withColumn("turns", read_turns(F.col("formatted"))).collect()
    assert [[(t.role, t.text) for t in r.turns] for r in found] == [[("", "first"), ("user", ""), ("user", ""), ("assistant", "z")]]
    assert format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text(spark):
    text = "<|" * 100_000
    row = formatted(spark, [(1, 0, "assistant", text)])[1]
    assert hashlib.sha256(row.loss.encode()).hexdigest() == hashlib.sha256(text.encode()).hexdigest()


def test_template_is_checked():
    with pytest.raises(ValueError):
        Template(opening="[INST]")
    with pytest.raises(ValueError):
        Template(closing="<|im_start|>\n")
