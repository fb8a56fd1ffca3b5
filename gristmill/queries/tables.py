"""The given tables and the specs that the registered queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.sources.readers import read_table

DOCUMENT_SPEC = {
    "name": "web_documents",
    "fields": {
        "text": {"type": "str", "min_length": 1, "max_length": 5000, "description": "running text"},
        "lang": {"type": "enum", "values": ["en", "de", "fr"]},
        "source": {"type": "str", "optional": True},
        "n_chars": {"type": "int", "ge": 0, "le": 4000},
    },
    "text_field": "text",
    "label_fields": ["lang", "source"],
    "generation": {
        "system": "Return only valid JSON.",
        "instructions": "Vary topic and length.",
        "scenario_hints": [
            "a short notice",
            "a long report",
            "a product page",
            "a forum answer",
            "a news item",
            "a recipe",
            "a travel note",
        ],
    },
    "judge": {"dimensions": ["realism", "coherence", "label_fit"], "system": "Rate the record."},
    "chat_export": {
        "system": "Name the language.",
        "user_template": "{text}",
        "assistant_template": "language: {lang}",
    },
}

JUDGE_DIMENSIONS = DOCUMENT_SPEC["judge"]["dimensions"]


def table(spark: SparkSession, folder: str, name: str, spread_by: str | None = None) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", spread_by)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Texts are the one input whose work is all computing, so a single small file is spread."""
    return table(spark, folder, "documents", spread_by="doc_id")


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).join(table(spark, folder, "labels"), "doc_id", "left")


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
