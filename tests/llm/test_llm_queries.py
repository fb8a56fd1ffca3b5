"""Registered queries on the smallest given tables: SQL where there is some, else what each must hold."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from oracle import compare, connect

from __spark_entry__ import oracle_sql, queries
from gristmill.llm import pipeline
from gristmill.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no given tables")


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{DATA}/documents.parquet")


def result(spark, name):
    return QUERIES[name](spark, DATA).toPandas()


def test_all_are_registered():
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())
    assert {int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")} == set(range(1, 14))
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "packing"]


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, name):
    assert compare(spark, connect(DATA), DATA, QUERIES[name], SQL[name]) == ""


def test_language(spark, docs):
    found = result(spark, "op1_language_id").merge(docs, on="doc_id")
    assert len(found) == len(docs)
    assert (found.held_out == [crc(i) % 3 == 1 for i in found.doc_id]).all()
    held = found[found.held_out & found.lang.notna()]
    assert (held.lang == held.lang_pred).mean() > 0.95


def test_quality(spark, docs):
    found = result(spark, "op3_quality")
    assert len(found) == len(docs) and (found.held_out == [crc(i) % 4 == 2 for i in found.doc_id]).all()
    assert ((found.score >= 0.7) == (found.predicted == 1)).all()


def test_language_model(spark, docs):
    found = result(spark, "op7_lm_score")
    assert len(found) == len(docs) and (found.held_out == [crc(i) % 10 == 0 for i in found.doc_id]).all()
    assert found.train_tokens.nunique() == 1 and (found.score < 0).all()
    assert found.score.sum() > found.base_score.sum()


def test_neighbours(spark):
    found = result(spark, "op10_random_projection_forest")
    table = pd.read_parquet(f"{DATA}/embeddings.parquet")
    vectors, ids = np.array(table.embedding.tolist(), np.float64), table.vec_id.to_numpy()
    hits = []
    for q in ids[ids % 100 == 0]:
        distance = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        distance[ids == q] = np.inf
        hits.append(len(set(ids[np.lexsort((ids, distance))[:10]]) & set(found[found.query_id == q].vec_id)))
    assert np.mean(hits) >= 9


def test_packing_and_licences(spark, docs):
    pieces = result(spark, "op2_vector_packing")
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
    assert set(pieces.doc_id) == set(docs.doc_id)
    licences = result(spark, "op5_licences")
    own = docs[docs.text.str.contains("Apache License", na=False)].doc_id
    assert set(licences[licences.own_licence == "Apache-2.0"].doc_id) == set(own)
