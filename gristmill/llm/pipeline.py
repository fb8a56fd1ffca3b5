"""The corpus pipeline: operators of this subpackage as stages over documents.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps; between stages the
documents are written as Parquet to the shared folder and read again, so a lost executor costs a stage
at most, and each stage sees the counts and files of the one before. Documents may have further columns
of any name, which pass unchanged. Rows without an id pass the stages that work by id unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import decontam, langid, nearcopies, packing, substrings
from gristmill.llm.shipping import ship
from gristmill.llm.slabs import bundled
from gristmill.session import Scope


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with the identified one as ``lang``.

    Those without text or letters are rejected, and no others. If no language can be learned (none is given),
    the documents with letters stay with their ``lang``.
    """
    ship(spark)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = langid.fit(docs, fold != 1)
    kept = docs.filter(F.col("text").isNotNull())
    if not model.families:
        # Nothing could be learned: the text alone decides.
        return kept.filter(F.col("text").rlike(r"\p{L}"))
    found = kept.select(F.col("text"), bundled(docs, "text").alias("row"), langid.language(F.col("text"), model).alias("of"))
    found = found.filter(F.col("of.lang_pred") != langid.UNKNOWN)
    made = {"text": F.col("text"), "lang": F.col("of.lang_pred")}
    return found.select(*[made.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies (five-word shingles, 0.8).

    Rows that repeat an id and a text are one document, of which one row stays.
    """
    ship(spark)
    scope = Scope(spark)
    found, _ = nearcopies.near_copies(docs.select("doc_id", "text"))
    ids = found.groupBy("id").agg(F.bool_or("kept").alias("stays"), F.count(F.lit(1)).alias("rows"))
    marked = scope.stage(ids.filter("not stays or rows > 1").select(F.col("id").alias("doc_id"), "stays"), "marked")
    once = docs.join(marked, "doc_id", "left_anti").select(*docs.columns)
    again = marked.filter("stays")
    if again.isEmpty():
        return once
    repeated = docs.join(again, "doc_id", "left_semi").select(*docs.columns)
    return once.unionAll(repeated.dropDuplicates(["doc_id", "text"]))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that occur earlier; a text that changes has a new length."""
    ship(spark)
    found = substrings.remove_repeats(docs.select("doc_id", "text", bundled(docs, "text").alias("row")))
    changed = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))
        changed["n_chars"] = n_chars
    return found.select(*[changed.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    ship(spark)
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    ship(spark)
    import public_tokenizers

    return packing.pack_texts(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

# Learned languages, signatures and packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scope = Scope(spark)
    for name, stage in STAGES[:-1]:
        docs = scope.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
