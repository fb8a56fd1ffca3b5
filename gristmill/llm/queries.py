"""Registered queries of the training-data operators over the given tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import pipeline
from gristmill.llm.shipping import ship


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(folds: int) -> Column:
    """The fold of a row of documents: the checksum of its id as text, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from gristmill.llm import langid

    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs, fold(3) != 1)
    found = langid.identify(docs.select("doc_id", "text"), model).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


def op2_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from gristmill.llm.packing import pack_texts

    docs = read(spark, folder, "documents").select("doc_id", "text")
    return pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    from gristmill.llm import quality

    docs = read(spark, folder, "documents").select("doc_id", "text")
    vectors = quality.word_vectors(docs)
    network = quality.fit(docs, read(spark, folder, "labels"), vectors, fold(4) != 2)
    found = quality.score(docs, vectors, network).withColumnRenamed("id", "doc_id")
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "score", predicted)


# A conversation whose texts hold the template's own control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    from gristmill.llm.chat import format_conversations, loss_text, read_turns

    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    made = format_conversations(turns.unionAll(own))
    lines = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read_back = made.select("conv_id", lines.alias("lines"), loss_text(F.col("segments")).alias("loss"), "formatted")
    return read_back.select(
        "conv_id",
        F.size("lines").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", "lines"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: ``source/shelf/box/name``, a shelf holds 1024 ids and a box 32.

    The first document of a shelf or box is its licence file.
    """
    from gristmill.llm.licences import scan

    docs = read(spark, folder, "documents").select("doc_id", "source", "text")
    shelf, box = F.expr("doc_id div 1024").cast("string"), F.expr("doc_id div 32").cast("string")
    top, first = F.col("doc_id") % 1024 == 0, F.col("doc_id") % 32 == 0
    path = (
        F.when(top, F.concat_ws("/", "source", shelf, F.lit("LICENSE")))
        .when(first, F.concat_ws("/", "source", shelf, box, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", "source", shelf, box, F.col("doc_id").cast("string")))
    )
    found, _ = scan(docs.select("doc_id", path.alias("path"), "text"))
    return found.select("doc_id", "path", "own_licence", F.round("own_score", 6).alias("own_score"), "licence", "inherited_from")


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from gristmill.llm.decontam import contaminated, matches

    docs = read(spark, folder, "documents").select("doc_id", "text")
    found, _ = matches(docs, read(spark, folder, "benchmark"))
    names = F.array_sort(F.transform("items", lambda item: item.cast("string")))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    from gristmill.llm.langmodel import score_texts

    docs = read(spark, folder, "documents").select("doc_id", "text")
    found, _ = score_texts(docs, fold(10) != 0)
    found = found.withColumnRenamed("id", "doc_id").withColumn("held_out", fold(10) == 0)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from gristmill.llm.substrings import remove_repeats

    found = remove_repeats(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from gristmill.llm.nearcopies import near_copies

    found, _ = near_copies(read(spark, folder, "documents").select("doc_id", "text"), shingle=4)
    return found.withColumnRenamed("id", "doc_id")


def op10_random_projection_forest(spark: SparkSession, folder: str) -> DataFrame:
    from gristmill.llm.neighbours import nearest

    return nearest(read(spark, folder, "embeddings"), F.col("id") % 100 == 0)[0]


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Repair of the damaged conversations; one that lost all its rows has zeros and the hash of nothing."""
    from gristmill.llm import repair

    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found, _ = repair.repair(repair.damaged(rows))
    every = rows.select(F.col("conv_id").alias("original")).distinct()
    joined = every.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")]
    return joined.select(F.col("original").alias("conv_id"), *counts, *texts)


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Variants among the words of all documents, one code point of some runs deleted by the rule of ``shorten``."""
    from gristmill.llm import spelling

    docs = read(spark, folder, "documents").select("doc_id", "text")
    return spelling.variants(spelling.word_counts(docs, damage=spelling.shorten))[0]


def op13_small_world(spark: SparkSession, folder: str) -> DataFrame:
    from gristmill.llm.smallworld import near_vectors

    return near_vectors(read(spark, folder, "embeddings").select("vec_id", "embedding"))[0]


QUERIES = {
    "pipeline": pipeline.run,
    "op1_language_id": op1_language_id,
    "op2_vector_packing": op2_vector_packing,
    "op3_quality": op3_quality,
    "op4_chat_format": op4_chat_format,
    "op5_licences": op5_licences,
    "op6_decontamination": op6_decontamination,
    "op7_lm_score": op7_lm_score,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_random_projection_forest": op10_random_projection_forest,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_small_world": op13_small_world,
}

UPPER, PLAIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words of a text, as list expressions: runs of non-blank characters, and the benchmark's words.
BLANK_WORDS = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"
LOWER_WORDS = BLANK_WORDS.format(f"translate(text, '{UPPER}', '{PLAIN}')")
TEST_WORDS = (
    f"regexp_extract_all(coalesce(translate(text, '{UPPER}', '{PLAIN}'), ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

# The CRC-32 of a text's UTF-8 bytes: a table made from the polynomial, and a fold over the bytes.
CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS v FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)
  )
)"""
CRC = """xor(4294967295, list_reduce(
  list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, octet_length(encode({0})) + 1),
    lambda k: CAST(('0x' || substr(hex(encode({0})), 2 * k - 1, 2)) AS BIGINT))),
  lambda c, x: xor(c >> 8, crc_table.v[1 + (xor(c, x) & 255)])
))"""

SQL: dict[str, str] = {
    "op4_chat_format": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|><|im_end|>') + 2 + length(role)
    + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
""",
    "op6_decontamination": f"""
WITH docs AS (SELECT doc_id, {TEST_WORDS} AS w FROM documents),
items AS (SELECT item_id, {TEST_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM docs, sizes)
),
met AS (SELECT doc_id, item_id, size, p FROM places JOIN windows USING (size, phrase)),
hits AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM met) GROUP BY doc_id),
found AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op8_substring_dedup": f"""
WITH docs AS (SELECT doc_id, {BLANK_WORDS.format('text')} AS w FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(w[p : p + 19], ' ') AS phrase
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM docs WHERE len(w) >= 20)
),
again AS (
  SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM again),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS q, unnest(w) AS word FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS text FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
""",
    "op9_minhash_dedup": f"""
WITH RECURSIVE docs AS (SELECT doc_id, {LOWER_WORDS} AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM docs WHERE len(w) > 0)
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS MATERIALIZED (
  SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id < b.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT i, j FROM common JOIN sizes x ON x.doc_id = i JOIN sizes y ON y.doc_id = j WHERE 100 * c >= 80 * (x.n + y.n - c)
),
both_ways AS MATERIALIZED (SELECT i, j FROM links UNION ALL SELECT j, i FROM links),
reach(doc_id, other) AS (
  SELECT i, j FROM both_ways UNION SELECT reach.doc_id, both_ways.j FROM reach JOIN both_ways ON both_ways.i = reach.other
),
least_of AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(other, doc_id)) AS kept
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)
""",
    "op11_conversation_repair": f"""
WITH RECURSIVE {CRC_TABLE},
rows AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS keyed FROM conversations
),
fates AS (SELECT conv_id, turn, role, text, {CRC.format("keyed")} % 20 AS fate FROM rows, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM fates)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    left(role, 1) AS c, trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS bare
  FROM damaged
),
turns AS MATERIALIZED (
  SELECT conv_id, turn, role, text, i, c, bare = '' AS blank, bare <> '' AND again AS again,
    bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut,
    i > 1 AND lag(c, 1, '') OVER (PARTITION BY conv_id ORDER BY i) || c NOT IN ('su', 'ua', 'au') AS illegal
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed)
),
facts AS MATERIALIZED (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM turns GROUP BY conv_id
),
-- Cheapest edits of the turns from i on, if an assistant, a user, a system turn or no more than these is due.
best(conv_id, i, a, u, s, z) AS (
  SELECT conv_id, n + 1, {{'c': CAST(2 AS BIGINT), 'e': 'I'}}, {{'c': CAST(4 AS BIGINT), 'e': 'II'}}, {{'c': CAST(1000000000 AS BIGINT), 'e': ''}}, {{'c': CAST(0 AS BIGINT), 'e': ''}}
  FROM facts
  UNION ALL
  SELECT conv_id, i, list_min([a, {{'c': z.c + 2, 'e': 'I' || z.e}}, {{'c': u.c + 2, 'e': 'I' || u.e}}]),
    list_min([u, {{'c': a.c + 2, 'e': 'I' || a.e}}, {{'c': z.c + 4, 'e': 'II' || z.e}}]), s, z
  FROM (
    SELECT b.conv_id, t.i,
      list_min([{{'c': b.a.c + 3, 'e': 'D' || b.a.e}}, {{'c': least(b.z, b.u).c + CASE WHEN blank OR again THEN 1000000000 ELSE 0 END
        + CASE t.c WHEN 'a' THEN 0 ELSE 2 END + CASE WHEN cut THEN 1 ELSE 0 END, 'e': CASE t.c WHEN 'a' THEN 'K' ELSE 'R' END || least(b.z, b.u).e}}]) AS a,
      list_min([{{'c': b.u.c + 3, 'e': 'D' || b.u.e}}, {{'c': b.a.c + CASE WHEN blank OR again THEN 1000000000 ELSE 0 END
        + CASE t.c WHEN 'u' THEN 0 ELSE 2 END + CASE WHEN cut THEN 1 ELSE 0 END, 'e': CASE t.c WHEN 'u' THEN 'K' ELSE 'R' END || b.a.e}}]) AS u,
      list_min([{{'c': b.s.c + 3, 'e': 'D' || b.s.e}}, {{'c': b.u.c + CASE WHEN blank OR again OR t.c <> 's' THEN 1000000000 ELSE 0 END
        + CASE WHEN cut THEN 1 ELSE 0 END, 'e': 'K' || b.u.e}}]) AS s,
      {{'c': b.z.c + 3, 'e': 'D' || b.z.e}} AS z
    FROM best b JOIN turns t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.i = b.i - 1
  )
),
audits AS MATERIALIZED (SELECT conv_id, list_min([u, s, z]) AS best FROM best WHERE i = 1),
edits AS (
  SELECT conv_id, p, substr(best.e, p, 1) AS e FROM (SELECT conv_id, best, unnest(range(1, length(best.e) + 1)) AS p FROM audits)
),
counted AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS o FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY p)
),
made AS (
  SELECT d.conv_id, p, e, o, role, text, max(CASE WHEN o = 1 AND e = 'K' AND c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY d.conv_id) AS led
  FROM counted d LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM d.conv_id AND t.i = d.i AND d.e <> 'I'
),
repaired AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN e = 'K' THEN role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p
  )) AS hash FROM made WHERE e <> 'D' GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.e, '') AS audit,
  coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits u ON u.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{PLAIN}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run
),
hashed AS (SELECT run, k, {CRC.format("keyed")} AS h FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS keyed FROM runs), crc_table),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
holes AS MATERIALIZED (
  SELECT word, i, left(word, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
),
one_longer AS (SELECT DISTINCT words.word AS x, holes.word AS y FROM holes JOIN words ON words.word = holes.a || holes.b),
near AS MATERIALIZED (
  SELECT p.word AS word, q.word AS other FROM holes p JOIN holes q USING (i, a, b) WHERE p.word <> q.word
  UNION ALL SELECT x, y FROM one_longer UNION ALL SELECT y, x FROM one_longer
),
ranked AS (
  SELECT near.word, other, words.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY words.n DESC, other) AS place
  FROM near JOIN words ON words.word = near.other
),
forms AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
    CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN ranked ON ranked.word = words.word AND place = 1
),
steps(word, step) AS (
  SELECT word, word FROM forms UNION ALL SELECT steps.word, forms.form FROM steps JOIN forms ON forms.word = steps.step WHERE forms.form IS NOT NULL
),
roots AS (SELECT steps.word, step AS root FROM steps JOIN forms ON forms.word = steps.step WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
""",
    "op13_small_world": """
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
both_ways AS MATERIALIZED (
  SELECT a.vec_id AS i, b.vec_id AS j FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) >= 0.9 * sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))
),
reach(vec_id, other) AS (
  SELECT i, j FROM both_ways UNION SELECT reach.vec_id, both_ways.j FROM reach JOIN both_ways ON both_ways.i = reach.other
),
least_of AS (SELECT vec_id, min(other) AS other FROM reach GROUP BY vec_id),
counts AS (SELECT i AS vec_id, count(*) AS n FROM both_ways GROUP BY i)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(other, vec_id)) AS kept
FROM embeddings LEFT JOIN counts USING (vec_id) LEFT JOIN least_of USING (vec_id)
""",
}
