"""Validation, coverage, harvesting, chat examples and prompts over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators.prompts import prompt_batches, prompt_routing
from gristmill.operators.validate import (
    ITEM,
    field_coverage,
    first_records,
    harvest,
    harvest_valid,
    invalid_records,
    valid_records,
)
from gristmill.queries import sql
from gristmill.queries.tables import DOCUMENT_SPEC, documents, labelled_documents, row_count, table
from gristmill.sources.readers import seed_examples
from gristmill.sources.writers import chat_examples

FIELDS = DOCUMENT_SPEC["fields"]
COVERED = ["text", "lang", "source", "n_chars", "quality", "toxic", "absent"]
RESPONSE_FIELDS = {name: FIELDS[name] for name in ("text", "lang", "n_chars")}
CHAT = {
    "system": "Continue the conversation.",
    "user_template": "[{role}] {text}",
    "assistant_template": "{{turn}} {turn}{unknown}",
}


def validate_valid(spark: SparkSession, folder: str) -> DataFrame:
    return valid_records(table(spark, folder, "documents"), FIELDS, ["doc_id"])


def validate_errors(spark: SparkSession, folder: str) -> DataFrame:
    bad = invalid_records(table(spark, folder, "documents"), FIELDS, "doc_id")
    return bad.select("doc_id", F.array_join("errors", "; ").alias("errors"))


def coverage(spark: SparkSession, folder: str) -> DataFrame:
    return field_coverage(labelled_documents(spark, folder), COVERED)


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """One raw model response per document, in all the shapes a model may answer in."""
    docs = documents(spark, folder)
    record = F.to_json(F.struct("text", "lang", "n_chars"))
    partial = F.to_json(F.struct("lang", "n_chars"))
    shape = F.col("doc_id") % 6

    def joined(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    raw = (
        F.when(shape == 0, joined('{"records": [', record, "]}"))
        .when(shape == 1, joined('{"items": [', record, ", ", partial, "], ", '"note": "two"}'))
        .when(shape == 2, record)
        .when(shape == 3, joined("[", record, ", 7, ", record, "]"))
        .when(shape == 4, joined('{"records": [', record))
        .otherwise(joined('{"tickets": ', record, ', "data": [', record, "]}"))
    )
    return docs.select(F.col("doc_id").alias("batch_no"), raw.alias("raw"))


def harvest_responses(spark: SparkSession, folder: str) -> DataFrame:
    items = harvest(responses(spark, folder), "batch_no", "raw")
    return items.select(
        "batch_no",
        F.col("item_no").cast("bigint").alias("item_no"),
        F.char_length(F.try_variant_get(ITEM, "$.text", "string")).cast("bigint").alias("text_chars"),
        F.try_variant_get(ITEM, "$.lang", "string").alias("lang"),
    )


def harvest_trim(spark: SparkSession, folder: str) -> DataFrame:
    wanted = row_count(table(spark, folder, "documents")) // 2
    found = harvest_valid(responses(spark, folder), "batch_no", "raw", RESPONSE_FIELDS)
    first = first_records(found, ["batch_no", "item_no"], wanted)
    return first.withColumn("item_no", F.col("item_no").cast("bigint"))


def chats(spark: SparkSession, folder: str) -> DataFrame:
    examples = chat_examples(table(spark, folder, "conversations"), CHAT)
    messages = F.col("messages")
    return examples.select(
        F.size(messages).cast("bigint").alias("turns"),
        messages[0]["content"].alias("system"),
        F.concat_ws(":", messages[1]["role"], messages[1]["content"]).alias("first"),
        F.concat_ws(":", messages[2]["role"], messages[2]["content"]).alias("second"),
    )


def prompts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    seeds = [row.asDict() for row in seed_examples(docs.select("doc_id", "lang", "source"), "doc_id").collect()]
    return prompt_batches(spark, DOCUMENT_SPEC, row_count(docs), seeds=seeds)


def routing(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    # Stands for rewritten prompts made elsewhere: user turns came back as their first sentence.
    rewritten = F.when(F.col("role") == "user", F.substring_index("text", ".", 1))
    sized = prompt_routing(turns.withColumn("shorter", rewritten), "text", "shorter")
    return sized.drop("text", "shorter")


QUERIES = {
    "validate_valid": validate_valid,
    "validate_errors": validate_errors,
    "field_coverage": coverage,
    "harvest_responses": harvest_responses,
    "harvest_trim": harvest_trim,
    "chat_examples": chats,
    "prompt_batches": prompts,
    "prompt_routing": routing,
}

_BROKEN = {
    "text: required": "text IS NULL",
    "text: shorter than 1": "length(text) < 1",
    "text: longer than 5000": "length(text) > 5000",
    "lang: required": "lang IS NULL",
    "lang: not one of the listed values": "lang NOT IN ('en', 'de', 'fr')",
    "n_chars: required": "n_chars IS NULL",
    "n_chars: below 0": "n_chars < 0",
    "n_chars: above 4000": "n_chars > 4000",
}
_MESSAGES = ", ".join(f"CASE WHEN {test} THEN {sql.text(m)} END" for m, test in _BROKEN.items())
VALID = (
    "text IS NOT NULL AND length(text) BETWEEN 1 AND 5000 AND lang IN ('en', 'de', 'fr') "
    "AND n_chars BETWEEN 0 AND 4000"
)
_ITEMS = """
  SELECT doc_id AS batch_no, CAST(k AS BIGINT) AS item_no, text, lang, n_chars, doc_id % 6 AS shape
  FROM documents, (SELECT unnest([0, 1, 2]) AS k)
  WHERE CASE doc_id % 6 WHEN 1 THEN k < 2 WHEN 3 THEN k < 3 WHEN 4 THEN false ELSE k < 1 END"""


def _coverage_sql() -> str:
    source = "documents LEFT JOIN labels USING (doc_id)"
    tests = {
        "text": "text IS NOT NULL AND text <> ''",
        "lang": "lang IS NOT NULL AND lang <> ''",
        "source": "source IS NOT NULL AND source <> ''",
        "n_chars": "n_chars IS NOT NULL",
        "quality": "quality IS NOT NULL",
        "toxic": "toxic IS NOT NULL",
        "absent": "false",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS field, round(avg(CASE WHEN {test} THEN 1.0 ELSE 0.0 END), 4) AS coverage FROM {source}"
        for name, test in tests.items()
    )


def _prompt_sql() -> str:
    generation = DOCUMENT_SPEC["generation"]
    hints = ", ".join(
        f"{{'h': {sql.bits(42, 'hints', str(n), 'b')}, 'hint': {sql.text(hint)}}}"
        for n, hint in enumerate(generation["scenario_hints"])
    )
    schema = (
        '{"type":"object","properties":{"text":{"type":"string","minLength":1,"maxLength":5000,"description":"running text"},'
        '"lang":{"enum":["en","de","fr"]},"source":{"type":["string","null"]},'
        '"n_chars":{"type":"integer","minimum":0,"maximum":4000}},"required":["text","lang","n_chars"]}'
    )
    lead = f"\n\nRECORD SCHEMA (web_documents)\n{schema}\n\nNOTES\n{generation['instructions']}\n\nSAMPLES\n"
    return f"""
    WITH total AS (SELECT count(*) AS n FROM documents),
    seeds AS (
      SELECT string_agg('{{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '"}}', chr(10) ORDER BY doc_id) AS s
      FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 2)),
    batches AS (
      SELECT b, least(5, n - b * 5) AS need
      FROM (SELECT n, unnest(range(CAST(ceil(n / 5.0) AS BIGINT))) AS b FROM total)),
    drawn AS (
      SELECT b, need, unnest([{hints}]) AS d FROM batches),
    ranked AS (
      SELECT b, need, d.hint AS hint, row_number() OVER (PARTITION BY b ORDER BY d.h) AS r FROM drawn),
    lists AS (
      SELECT b, need, string_agg('(' || r || ') ' || hint, chr(10) ORDER BY r) AS hints FROM ranked WHERE r <= need + 1 GROUP BY b, need)
    SELECT b AS batch_no, need, 'Return only valid JSON.' AS system,
      'OUTPUT' || chr(10) || 'A JSON object whose key records is an array of length ' || need || {sql.text(lead)}
      || s || chr(10) || chr(10) || 'TOPICS' || chr(10) || hints AS prompt
    FROM lists, seeds"""


_W = r"len(regexp_extract_all({0}, '[^\s]+'))"
_T = "greatest({w}, length({0}) // 4)"
_FINAL = "CASE WHEN ow <= 50 OR role <> 'user' THEN text ELSE split_part(text, '.', 1) END"

SQL = {
    "validate_valid": f"SELECT doc_id, text, lang, source, n_chars FROM documents WHERE {VALID}",
    "validate_errors": f"""
      SELECT doc_id, array_to_string(list_filter([{_MESSAGES}], lambda m: m IS NOT NULL), '; ') AS errors
      FROM documents WHERE NOT ({VALID})""",
    "field_coverage": _coverage_sql(),
    "harvest_responses": f"""
      SELECT batch_no, item_no,
        CAST(CASE WHEN shape = 1 AND item_no = 1 OR shape = 3 AND item_no = 1 THEN NULL ELSE length(text) END AS BIGINT) AS text_chars,
        CASE WHEN shape = 3 AND item_no = 1 THEN NULL ELSE lang END AS lang
      FROM ({_ITEMS})""",
    "harvest_trim": f"""
      SELECT batch_no, item_no, text, lang, n_chars FROM ({_ITEMS})
      WHERE {VALID} AND NOT (shape IN (1, 3) AND item_no = 1)
      QUALIFY row_number() OVER (ORDER BY batch_no, item_no) <= (SELECT count(*) // 2 FROM documents)""",
    "chat_examples": """
      SELECT CAST(3 AS BIGINT) AS turns, 'Continue the conversation.' AS system,
        'user:[' || coalesce(role, '') || '] ' || coalesce(text, '') AS first,
        'assistant:{turn} ' || coalesce(CAST(turn AS VARCHAR), '') AS second
      FROM conversations""",
    "prompt_batches": _prompt_sql(),
    "prompt_routing": f"""
      WITH sized AS (
        SELECT *, {_W.format('text')} AS ow FROM (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations)),
      final AS (SELECT *, {_FINAL} AS out FROM sized),
      counted AS (
        SELECT *, {_T.format('text', w='ow')} AS ot, {_W.format('out')} AS fw FROM final),
      done AS (SELECT *, {_T.format('out', w='fw')} AS ft FROM counted)
      SELECT conv_id, turn, role,
        CASE WHEN ow <= 50 THEN 'passthrough' WHEN role <> 'user' THEN 'passthrough (rewrite failed)' ELSE 'llm-rewrite' END AS method,
        CAST(ow AS BIGINT) AS original_words, CAST(ot AS BIGINT) AS original_tokens,
        CAST(fw AS BIGINT) AS final_words, CAST(ft AS BIGINT) AS final_tokens,
        round(CASE WHEN ot = 0 THEN 0.0 ELSE (1 - CAST(ft AS DOUBLE) / ot) * 100 END, 1) AS reduction_pct
      FROM done""",
}
