"""Near-duplicates, diversity and full evaluation over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.text import default_stop_words
from gristmill.operators import diversity
from gristmill.operators.neardup import copy_groups, dedupe, near_duplicate_count, near_duplicates
from gristmill.operators.tfidf import tfidf
from gristmill.plans.evaluate import evaluate, quality_report
from gristmill.queries import judging, sql
from gristmill.queries.records import VALID
from gristmill.queries.tables import DOCUMENT_SPEC, JUDGE_DIMENSIONS, documents, labelled_documents

LABELS = ["lang", "quality", "toxic"]


def tfidf_weights(spark: SparkSession, folder: str) -> DataFrame:
    weights = tfidf(documents(spark, folder), "doc_id", "text")
    return weights.select(
        F.col("id").alias("doc_id"), "term", "tf", "df", F.round("weight", 6).alias("weight")
    )


def near_dup_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder), "doc_id", "text").pairs


def near_dup_copies(spark: SparkSession, folder: str) -> DataFrame:
    texts = documents(spark, folder).select(F.col("doc_id").alias("id"), "text")
    members = copy_groups(texts, default_stop_words())
    return members.filter(F.col("id") > F.col("rep")).select(
        F.col("id").alias("doc_id"), F.col("rep").alias("copy_of")
    )


def near_dup_flag_count(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_count(documents(spark, folder), "doc_id", "text")


def dedupe_kept(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe(documents(spark, folder), "doc_id", "text").select("doc_id", "lang", "source", "n_chars")


def mean_pairwise_distance(spark: SparkSession, folder: str) -> DataFrame:
    return diversity.mean_pairwise_distance(documents(spark, folder), "doc_id", "text")


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return diversity.token_counts(documents(spark, folder), "doc_id", "text")


def distinct_n(spark: SparkSession, folder: str) -> DataFrame:
    return diversity.distinct_n(documents(spark, folder), "text", 2)


def vocabulary_size(spark: SparkSession, folder: str) -> DataFrame:
    return diversity.vocabulary_size(documents(spark, folder), "text")


def label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return diversity.label_counts(labelled_documents(spark, folder), LABELS)


def label_balance(spark: SparkSession, folder: str) -> DataFrame:
    return diversity.normalized_entropy(
        diversity.label_counts(labelled_documents(spark, folder), LABELS), "field"
    )


def diversity_report(spark: SparkSession, folder: str) -> DataFrame:
    return diversity.diversity_report(labelled_documents(spark, folder), "doc_id", "text", LABELS)


def evaluate_summary(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate(documents(spark, folder), DOCUMENT_SPEC, "doc_id").metrics


def evaluate_judged(spark: SparkSession, folder: str) -> DataFrame:
    """Full evaluation with responses of the judge for every clean document; its verdict can fail."""
    return evaluate(documents(spark, folder), DOCUMENT_SPEC, "doc_id", responses=judging.judge_responses(spark, folder)).metrics


def quality_report_rows(spark: SparkSession, folder: str) -> DataFrame:
    result = evaluate(documents(spark, folder), DOCUMENT_SPEC, "doc_id")
    return quality_report(result, DOCUMENT_SPEC, "doc_id")


QUERIES = {
    "tfidf_weights": tfidf_weights,
    "near_dup_pairs": near_dup_pairs,
    "near_dup_copies": near_dup_copies,
    "near_dup_flag_count": near_dup_flag_count,
    "dedupe_kept": dedupe_kept,
    "mean_pairwise_distance": mean_pairwise_distance,
    "token_counts": token_counts,
    "distinct_n": distinct_n,
    "vocabulary_size": vocabulary_size,
    "label_distribution": label_distribution,
    "label_balance": label_balance,
    "diversity_report": diversity_report,
    "evaluate_summary": evaluate_summary,
    "evaluate_judged": evaluate_judged,
    "quality_report": quality_report_rows,
}

_DOCS = "src AS (SELECT doc_id AS id, text FROM documents)"
_FILLED = f"filled AS (SELECT id, text FROM src WHERE NOT {sql.blank('text')})"
_LABELLED = "src AS (SELECT doc_id AS id, text, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"


def _labels(select: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS field, coalesce(CAST({f} AS VARCHAR), 'None') AS label, count(*) AS count FROM src GROUP BY 2"
        for f in LABELS
    )
    return f"WITH {_LABELLED}, counts AS ({parts}) {select}"


def _evaluation(report: bool, judged: bool = False) -> str:
    fields = list(DOCUMENT_SPEC["fields"])
    cells = "round_even(greatest(0, least(1, {0})) * 20, 0)"
    drawn = "repeat('█', CAST({c} AS INTEGER)) || repeat('░', CAST(20 - {c} AS INTEGER))"
    coverage = " UNION ALL ".join(
        f"""SELECT 'validation', 'coverage', '{f}', round(avg(CASE WHEN {f} IS NOT NULL AND CAST({f} AS VARCHAR) <> '' THEN 1.0 ELSE 0.0 END), 4), NULL
        FROM valid"""
        for f in fields
    )
    one = "SELECT '{0}', '{1}', NULL, CAST(({2}) AS DOUBLE), NULL"
    parts = [
        "SELECT 'summary' AS section, 'input_records' AS metric, CAST(NULL AS VARCHAR) AS item, "
        "CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS detail FROM documents",
        one.format("summary", "valid_records", "SELECT count(*) FROM valid"),
        one.format("summary", "clean_records", "SELECT count(*) FROM clean"),
        one.format("summary", "duplicates_removed", "SELECT count(*) FROM removed"),
        one.format("validation", "errors", "SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM valid)"),
        coverage,
        one.format("dedup", "pairs", "SELECT count(*) FROM sims"),
        one.format("dedup", "threshold", "SELECT 0.92"),
        "SELECT 'diversity', metric, item, value, NULL FROM diversity",
        "SELECT 'verdict', 'verdict', NULL, CAST(NULL AS DOUBLE), 'PASS'",
    ]
    if judged:
        parts[-1] = one.format("judge", "judged", "SELECT judged FROM means")
        parts += [f"SELECT 'judge', 'mean', '{d}', {d}, NULL FROM means" for d in JUDGE_DIMENSIONS]
        parts += [one.format("judge", name, f"SELECT {name} FROM means") for name in ("overall_mean", "flagged")]
        parts.append(f"SELECT 'verdict', 'verdict', NULL, CAST(NULL AS DOUBLE), {judging.VERDICT} FROM means")
    select = "SELECT section, metric, item, value, detail FROM metrics"
    if report:
        share = "CASE WHEN metric = 'coverage' THEN value ELSE value / sum(value) OVER (PARTITION BY metric) END"
        bar = drawn.format(c=cells.format("share"))
        select = f"""
        SELECT section, metric, item, value,
          CASE WHEN metric = 'coverage' OR metric LIKE 'label:%' THEN {bar} ELSE detail END AS detail
        FROM (SELECT *, {share} AS share FROM metrics)"""
    return f"""
    WITH RECURSIVE valid AS (SELECT * FROM documents WHERE {VALID}),
    src AS (SELECT doc_id AS id, text, lang, source FROM valid),
    {sql.vectors('src')}, {sql.all_pairs()}, {sql.greedy()},
    clean AS (SELECT * FROM src WHERE id NOT IN (SELECT id FROM removed)),
    filled AS (SELECT id, text FROM clean WHERE NOT {sql.blank('text')}),
    {sql.vectors('filled', 'cvec')},
    diversity AS ({sql.diversity('clean', 'cvec', DOCUMENT_SPEC['label_fields'])}),
    means AS ({judging.means(f"SELECT * FROM ({judging.SCORES}) WHERE doc_id IN (SELECT id FROM clean)")}),
    metrics AS ({' UNION ALL '.join(parts)})
    {select}"""


SQL = {
    "tfidf_weights": f"""
      WITH {_DOCS}, {sql.vectors('src')}
      SELECT id AS doc_id, term, tf, df, round(weight, 6) AS weight FROM vec""",
    "near_dup_pairs": f"""
      WITH {_DOCS}, {sql.vectors('src')}, {sql.all_pairs()}, {sql.copies()}
      SELECT i, j, round(cosine, 4) AS score, a.copies AS i_copies, b.copies AS j_copies
      FROM sims JOIN groups a ON a.id = i AND a.rep = i JOIN groups b ON b.id = j AND b.rep = j""",
    "near_dup_copies": f"""
      WITH {_DOCS}, {sql.vectors('src')}, {sql.copies()}
      SELECT id AS doc_id, rep AS copy_of FROM groups WHERE id > rep""",
    "near_dup_flag_count": f"""
      WITH {_DOCS}, {sql.vectors('src')}, {sql.all_pairs()} SELECT count(*) AS pairs FROM sims""",
    "dedupe_kept": f"""
      WITH RECURSIVE {_DOCS}, {sql.vectors('src')}, {sql.all_pairs()}, {sql.greedy()}
      SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT id FROM removed)""",
    "mean_pairwise_distance": f"""
      WITH {_DOCS}, {_FILLED}, {sql.vectors('filled')},
      pairs AS (
        SELECT sum(a.weight * b.weight) AS s FROM vec a JOIN vec b ON a.term = b.term AND a.id < b.id)
      SELECT round(1 - s / (n * (n - 1) / 2), 4) AS mean_pairwise_distance
      FROM pairs, (SELECT CAST(count(*) AS DOUBLE) AS n FROM filled)""",
    "token_counts": f"""
      SELECT doc_id, CAST(len({sql.words('text')}) AS BIGINT) AS tokens FROM documents""",
    "distinct_n": f"""
      SELECT round(count(DISTINCT g) / CAST(count(*) AS DOUBLE), 4) AS distinct_n FROM (
        SELECT [w[p], w[p + 1]] AS g FROM (
          SELECT w, unnest(range(1, len(w))) AS p FROM (SELECT {sql.words('text')} AS w FROM documents)))""",
    "vocabulary_size": f"""
      SELECT count(DISTINCT t) AS vocabulary_size FROM (SELECT unnest({sql.words('text')}) AS t FROM documents)""",
    "label_distribution": _labels("SELECT field, label, count FROM counts"),
    "label_balance": _labels(
        """SELECT field, round(-sum(p * ln(p)) / ln(count(*)), 4) AS balance
        FROM (SELECT field, count / CAST(sum(count) OVER (PARTITION BY field) AS DOUBLE) AS p FROM counts)
        GROUP BY field"""
    ),
    "diversity_report": f"""
      WITH {_LABELLED}, {_FILLED}, {sql.vectors('filled')} {sql.diversity('src', 'vec', LABELS)}""",
    "evaluate_summary": _evaluation(report=False),
    "evaluate_judged": _evaluation(report=False, judged=True),
    "quality_report": _evaluation(report=True),
}
