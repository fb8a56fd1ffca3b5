from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import langid

SCHEMA = "doc_id long, text string, lang string"
# Invented words whose endings tell the language.
ENDINGS = {
    "en": ["ing", "tion", "the", "of", "ly"],
    "de": ["ung", "heit", "der", "und", "lich"],
    "fr": ["eux", "ment", "les", "est", "ière"],
    "es": ["ción", "ado", "los", "una", "mente"],
    "xx": ["qqz", "zzx", "qxq", "xz", "zq"],
}


def corpus(n=500, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = list(ENDINGS)[i % 5]
        words = [draw.choice("abcdefst") + draw.choice("aeiou") + draw.choice(ENDINGS[lang]) for _ in range(draw.randint(6, 40))]
        rows.append((i, " ".join(words), lang))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = [*corpus(), (9000, None, "en"), (9001, "123 !!", "en"), (9002, "no label", None), (None, "x", "de")]
    return langid.fit(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") % 3 != 1)


def test_families_come_first(model):
    assert model.families == ["germanic", "romance", "xx"]
    assert model.languages == [["de", "en"], ["es", "fr"], ["xx"]]
    assert [len(p) for p in model.pairs] == [1, 1, 0]


def test_held_out_accuracy(spark, model):
    df = spark.createDataFrame(corpus(300, seed=2), SCHEMA).repartition(3)
    truth = {i: lang for i, _, lang in corpus(300, seed=2)}
    found = langid.identify(df.drop("lang"), model).collect()
    assert np.mean([r.lang_pred == truth[r.id] for r in found]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_texts_without_letters_and_extra_columns(spark, model):
    rows = [(1, None, 1), (2, "", 2), (3, "12 !? \n", 3), (None, "den der lung heit", 4), (4, "漢字", 5), (4, "x" * 3_000_000, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int")
    found = {r.id: (r.lang_pred, r.score) for r in df.select("id", langid.language(F.col("text"), model).alias("of")).select("id", "of.*").collect()}
    assert [found[k] for k in (1, 2, 3)] == [("und", 0.0)] * 3
    assert found[4][0] == "de" and found[5][0] != "und" and found[6][0] != "und"


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = langid.fit(empty, F.lit(True))
    assert langid.identify(empty, model).count() == 0
    one = spark.createDataFrame([(1, "abc", "en")], SCHEMA)
    assert langid.identify(one, model).first().lang_pred == "und"
    assert langid.identify(one, langid.fit(one, F.lit(True))).first().lang_pred == "en"


def test_long_texts_are_counted_whole(monkeypatch):
    values = [b"abc def" * 50, b"", b"other words here " * 9]
    whole = langid.features(values)
    monkeypatch.setattr(langid, "CHUNK", 17)
    assert np.allclose(langid.features(values), whole)


def test_sample_is_bounded_over_all_languages(spark, monkeypatch):
    """A thousand languages, and one id that many rows share, stay within the bound of the sample."""
    seen = []
    fitted = langid.fit_softmax
    monkeypatch.setattr(langid, "fit_softmax", lambda rows, *a: seen.append(len(rows)) or fitted(rows[:, :64].repeat(80, axis=1), *a)[:langid.DIMENSIONS + 1])
    monkeypatch.setattr(langid, "fit_machine", lambda *a: (np.zeros(langid.DIMENSIONS + 1), 1.0, 0.0))
    rows = [(7, f"word{i} text", f"l{i % 100}") for i in range(4000)] + [(8, "one text again", "l1")] * 500
    langid.fit(spark.createDataFrame(rows, SCHEMA), F.lit(True), sample=50, sample_all=300, families={})
    assert 150 < seen[0] < 500
