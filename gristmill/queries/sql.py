"""Building blocks of the SQL statements: draws, tokens, vectors, pairs, greedy removal."""

from __future__ import annotations

from gristmill.functions.draws import cumulative_shares
from gristmill.functions.text import default_stop_words


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def bits(seed: int, entity: str, field: str, row: str) -> str:
    key = f"'{seed}|{entity}|{field}|' || CAST({row} AS VARCHAR)"
    return f"CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT)"


def unit(seed: int, entity: str, field: str, row: str) -> str:
    return f"(CAST({bits(seed, entity, field, row)} AS DOUBLE) / CAST(4503599627370496 AS DOUBLE))"


def below(seed: int, entity: str, field: str, row: str, size: str | int) -> str:
    return f"CAST(floor({unit(seed, entity, field, row)} * CAST({size} AS DOUBLE)) AS BIGINT)"


def between(seed: int, entity: str, field: str, row: str, low: int, high: int) -> str:
    return f"({low} + {below(seed, entity, field, row, high - low + 1)})"


def choice(seed: int, entity: str, field: str, row: str, values: list) -> str:
    options = ", ".join(text(v) if isinstance(v, str) else str(v) for v in values)
    return f"([{options}])[{below(seed, entity, field, row, len(values))} + 1]"


def weighted(seed: int, entity: str, field: str, row: str, values: list[str], weights: list[float]) -> str:
    drawn = unit(seed, entity, field, row)
    ends = cumulative_shares(weights)
    cases = " ".join(
        f"WHEN {drawn} < CAST({end!r} AS DOUBLE) THEN {text(value)}" for value, end in zip(values[:-1], ends)
    )
    return f"CASE {cases} ELSE {text(values[-1])} END"


def days_from(anchor: str, days: str) -> str:
    return f"CAST(DATE '{anchor}' + CAST({days} AS INTEGER) AS VARCHAR)"


def record_id(prefix: str, row: str) -> str:
    return f"printf('{prefix}-%04d', {row} + 1)"


def words(column: str, at_least_two: bool = False) -> str:
    pattern = r"[\p{L}\p{N}_]{2,}" if at_least_two else r"[\p{L}\p{N}_]+"
    return f"regexp_extract_all(lower(coalesce({column}, '')), '{pattern}')"


def blank(column: str) -> str:
    """White space only. The tables hold no exotic white space."""
    return rf"(NOT regexp_matches(coalesce({column}, ''), '\S'))"


def stop_list() -> str:
    return ", ".join(text(word) for word in default_stop_words())


def vectors(source: str, name: str = "vec") -> str:
    """CTEs from ``source(id, text)`` to ``<name>(id, term, tf, df, weight)``."""
    return f"""
    {name}_tok AS (SELECT id, unnest({words('text', True)}) AS term FROM {source}),
    {name}_bag AS (
      SELECT id, term, count(*) AS tf FROM {name}_tok WHERE term NOT IN ({stop_list()}) GROUP BY id, term),
    {name}_voc AS (SELECT term, count(*) AS df FROM {name}_bag GROUP BY term),
    {name}_raw AS (
      SELECT id, term, tf, df,
        tf * (ln(CAST(1 + (SELECT count(*) FROM {source}) AS DOUBLE) / CAST(1 + df AS DOUBLE)) + 1) AS raw
      FROM {name}_bag JOIN {name}_voc USING (term)),
    {name} AS MATERIALIZED (
      SELECT id, term, tf, df, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM {name}_raw)"""


def all_pairs(vec: str = "vec", name: str = "sims", threshold: float = 0.92) -> str:
    """CTE ``<name>(i, j, cosine)`` by comparing every pair of texts that shares a term."""
    return f"""
    {name} AS MATERIALIZED (
      SELECT a.id AS i, b.id AS j, sum(a.weight * b.weight) AS cosine
      FROM {vec} a JOIN {vec} b ON a.term = b.term AND a.id < b.id
      GROUP BY a.id, b.id HAVING sum(a.weight * b.weight) >= CAST({threshold} AS DOUBLE))"""


def copies(vec: str = "vec", name: str = "groups") -> str:
    """CTE ``<name>(id, rep, copies)``: texts with the same terms and counts."""
    return f"""
    {name}_sig AS (
      SELECT id, string_agg(term || ':' || CAST(tf AS VARCHAR), ' ' ORDER BY term) AS sig FROM {vec} GROUP BY id),
    {name} AS (
      SELECT id, min(id) OVER (PARTITION BY sig) AS rep, count(*) OVER (PARTITION BY sig) AS copies
      FROM {name}_sig)"""


def greedy(sims: str = "sims", name: str = "removed") -> str:
    """CTE ``<name>(id)``: one walk over the later members in order, with the list of removed so far."""
    return f"""
    {name}_in AS MATERIALIZED (
      SELECT j, list(i) AS ins, row_number() OVER (ORDER BY j) AS k FROM {sims} GROUP BY j),
    {name}_walk AS (
      SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS gone
      UNION ALL
      SELECT n.k, CASE WHEN list_has_all(w.gone, n.ins) THEN w.gone ELSE list_append(w.gone, n.j) END
      FROM {name}_walk w JOIN {name}_in n ON n.k = w.k + 1),
    {name} AS MATERIALIZED (
      SELECT unnest(gone) AS id FROM {name}_walk WHERE k = (SELECT max(k) FROM {name}_walk))"""


def diversity(source: str, vec: str, fields: list[str], n: int = 2) -> str:
    """SELECT of ``(metric, item, value)`` rows from ``source(id, text, fields...)``.

    ``vec`` holds the vectors of the non-blank texts of ``source``.
    """
    filled = f"(SELECT count(*) FROM {source} WHERE NOT {blank('text')})"
    grams = " || ' ' || ".join(f"w[p + {k}]" for k in range(n))
    parts = [
        f"SELECT 'n_records' AS metric, CAST(NULL AS VARCHAR) AS item, CAST(count(*) AS DOUBLE) AS value FROM {source}",
        f"""SELECT 'distinct_{n}', NULL, round(coalesce(count(DISTINCT g) / CAST(nullif(count(*), 0) AS DOUBLE), 0), 4)
        FROM (SELECT {grams} AS g FROM (
          SELECT w, unnest(range(1, len(w) - {n} + 2)) AS p FROM (SELECT {words('text')} AS w FROM {source})))""",
        f"""SELECT 'vocabulary_size', NULL, CAST(count(DISTINCT t) AS DOUBLE)
        FROM (SELECT unnest({words('text')}) AS t FROM {source})""",
        f"""SELECT 'mean_pairwise_distance', NULL, round(CASE WHEN {filled} < 2 THEN 0.0 ELSE
          1 - (SELECT sum(s * s) - sum(q) FROM
                (SELECT sum(weight) AS s, sum(weight * weight) AS q FROM {vec} GROUP BY term))
              / (CAST({filled} AS DOUBLE) * ({filled} - 1)) END, 4)""",
        *label_parts(source, fields),
    ]
    return "\n UNION ALL ".join(parts)


def label_parts(source: str, fields: list[str]) -> list[str]:
    parts = []
    for field in fields:
        counts = f"SELECT coalesce(CAST({field} AS VARCHAR), 'None') AS l, count(*) AS c FROM {source} GROUP BY 1"
        parts.append(f"SELECT 'label:{field}' AS metric, l AS item, CAST(c AS DOUBLE) AS value FROM ({counts})")
        parts.append(
            f"""SELECT 'balance', '{field}', round(CASE WHEN count(*) > 1
            THEN -sum(c / t * ln(c / t)) / ln(count(*)) ELSE 0.0 END, 4)
            FROM (SELECT CAST(c AS DOUBLE) AS c, CAST(sum(c) OVER () AS DOUBLE) AS t FROM ({counts}))"""
        )
    return parts
