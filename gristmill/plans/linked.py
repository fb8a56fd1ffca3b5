"""Linked tables: generation from a spec, validation, quality and report rows."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators.diversity import diversity_report, label_stats
from gristmill.operators.fill import INDEX, overlay_scenarios, recombine, record_id, synthetic_columns
from gristmill.operators.indexing import dense_index, first_k
from gristmill.operators.judge import judge_means, parse_scores
from gristmill.operators.links import (
    assign_matching,
    children_of,
    copy_fields,
    draw_parent,
    fk_violations,
)
from gristmill.operators.neardup import near_duplicate_count
from gristmill.operators.prompts import prompt_batches
from gristmill.operators.validate import valid_records, validation_counts
from gristmill.plans.evaluate import EvaluationOptions, metric, metric_rows, union
from gristmill.session import stage
from gristmill.spec import (
    PoolDefaults,
    content_spec,
    fixed_fk,
    full_fields,
    generation_order,
    id_field,
    id_prefix,
    needed_entities,
    pool_plan,
)

log = logging.getLogger(__name__)



@dataclass(frozen=True)
class GenerationOptions:
    seed: int = 42
    n_records: int = 50
    pool: PoolDefaults = PoolDefaults()


def is_authored(entity: dict) -> bool:
    """Content comes from authored rows instead of draws."""
    return entity.get("generate", "synthetic") == "llm"


def generate_linked(
    spark: SparkSession,
    spec: dict,
    authored: dict[str, DataFrame] | None = None,
    options: GenerationOptions = GenerationOptions(),
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """All entities, or the ones in ``only``, parents first: content, foreign keys, copies, scenarios, ids.

    ``authored``: rows for entities with ``generate: llm``, with an integer order column ``_pos`` and the
    content fields. Every table has the dense position ``_idx``. A table that took a join is written to the
    shared folder once, for its children, checks and exports; one of drawn values only is cheaper to draw
    again. A drawn key needs no parent rows, because an id follows from a position. With ``only``, entities
    that the wanted ones are not made from are left out altogether; the rows of the others stay the same.
    """
    return generate_with_fallbacks(spark, spec, authored, options, only)[0]


def generate_with_fallbacks(
    spark: SparkSession,
    spec: dict,
    authored: dict[str, DataFrame] | None = None,
    options: GenerationOptions = GenerationOptions(),
    only: Sequence[str] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """The tables of ``generate_linked``, and ``(entity, fk, fallbacks)`` of the matched keys drawn for them.

    The join that draws a matched key flags its rows; the flags are written beside the table, so the counts
    are a scan of one column and no second join. None if no key was matched.
    """
    tables: dict[str, DataFrame] = {}
    sizes: dict[str, int] = {}
    counts: list[DataFrame] = []
    wanted = list(spec["entities"]) if only is None else needed_entities(spec, only)
    for name in generation_order(spec):
        if name not in wanted:
            continue
        build = _Entity(spark, spec, name, authored or {}, options, tables, sizes)
        table, sizes[name] = build.run()
        table = stage(table, name) if _took_a_join(spec["entities"][name]) else table
        for fk, flag in build.flags.items():
            lost = table.agg(F.count_if(F.col(f"`{flag}`")).alias("fallbacks"))
            counts.append(lost.select(F.lit(name).alias("entity"), F.lit(fk).alias("fk"), "fallbacks"))
        tables[name] = table.drop(*build.flags.values())
    shown = [name for name in wanted if only is None or name in only]
    return {name: tables[name] for name in shown}, union(counts) if counts else None


def authoring_prompts(
    spark: SparkSession,
    spec: dict,
    name: str,
    rows: int,
    options: GenerationOptions = GenerationOptions(),
    seeds: list[dict] | None = None,
) -> DataFrame:
    """The prompt table for an authored entity of ``rows`` rows: its pool, or all of them.

    Answers go through ``harvest_valid`` and come back to ``generate_linked`` as ``authored``.
    """
    entity = spec["entities"][name]
    plan = pool_plan(entity, rows, options.pool)
    wanted = plan.size if plan else rows
    return prompt_batches(spark, content_spec(name, entity), wanted, seeds=seeds, seed=options.seed)


def _took_a_join(entity: dict) -> bool:
    links = entity.get("relationships", {}).values()
    matched = any(link.get("match") for link in links)
    return bool(is_authored(entity) or entity.get("per_parent") or entity.get("copy") or matched)


@dataclass
class _Entity:
    """One entity's table in the making."""

    spark: SparkSession
    spec: dict
    name: str
    authored: dict[str, DataFrame]
    options: GenerationOptions
    tables: dict[str, DataFrame]
    sizes: dict[str, int]
    # Columns that flag the fallbacks of matched keys.
    flags: dict[str, str] = field(default_factory=dict)

    def run(self) -> tuple[DataFrame, int]:
        self.entity = self.spec["entities"][self.name]
        self.seed = self.options.seed
        self.links = self.entity.get("relationships", {})
        table, rows, fixed = self._frame()
        table, rows = self._content(table, rows)
        for fk, link in self.links.items():
            if fk != fixed:
                table = self._key(table, fk, link)
        for fk in self.links:
            table = self._copies(table, fk)
        lost = {
            column: F.lit(None).cast("string")
            for column, copied in self.entity.get("copy", {}).items()
            if copied["from"] not in self.links
        }
        if lost:
            table = table.withColumns(lost)
        table = overlay_scenarios(table, rows, self.entity.get("scenarios") or [], self.seed, self.name)
        row_id = record_id(id_prefix(self.name, self.entity), F.col(INDEX)).alias(id_field(self.entity))
        rest = [f"`{c}`" for c in table.columns if c != INDEX]
        return table.select(INDEX, row_id, *rest), rows

    def _frame(self) -> tuple[DataFrame, int, str | None]:
        """Bare rows ``(_idx)`` or children with the key of the parent they belong to."""
        per_parent = self.entity.get("per_parent")
        if not per_parent:
            count = max(0, int(self.entity.get("count", self.options.n_records)))
            return self.spark.range(count).toDF(INDEX), count, None
        parent = per_parent["parent"]
        low, high = int(per_parent.get("min", 1)), int(per_parent.get("max", 1))
        fk, parent_id = fixed_fk(self.entity), id_field(self.spec["entities"][parent])
        made = children_of(
            self.tables[parent], INDEX, self.sizes[parent], low, high, self.seed, self.name, [parent_id]
        ).drop("_child")
        made = made.withColumnRenamed(parent_id, fk) if fk else made.drop(parent_id)
        if low == high:
            return made, self.sizes[parent] * low, fk
        return made, made.count(), fk

    def _content(self, table: DataFrame, rows: int) -> tuple[DataFrame, int]:
        fields = self.entity.get("fields", {})
        if not is_authored(self.entity):
            drawn = synthetic_columns(self.seed, self.name, fields, F.col(INDEX))
            return table.select("*", *drawn), rows
        if self.name not in self.authored:
            raise ValueError(f"{self.name} needs authored rows")
        plan = pool_plan(self.entity, rows, self.options.pool)
        wanted = plan.size if plan else rows
        given = valid_records(self.authored[self.name], fields, ["_pos"])
        first = dense_index(given.filter(first_k(given, ["_pos"], wanted)), "_pos", INDEX).drop("_pos")
        content = stage(first, f"{self.name}-content", keep=True)
        got = content.count()
        if plan and got:
            return recombine(table, content, got, self.seed, self.name, plan.recombine, plan.fields), rows
        if got < rows:
            log.warning("%s: only %d of %d rows were authored", self.name, got, rows)
        return table.join(content, INDEX), min(rows, got)

    def _key(self, table: DataFrame, fk: str, link: dict) -> DataFrame:
        ref = link["ref"]
        target = self.spec["entities"][ref]
        parents = self.sizes.get(ref, 0)
        match = link.get("match")
        if match and parents:
            behind = self.links[match["via"]]["ref"]
            behind_id = id_field(self.spec["entities"][behind])
            shared = match["field"]
            if shared in self.tables[behind].columns:
                via_rows = self.tables[behind].select(
                    F.col(behind_id).alias("id"), F.col(f"`{shared}`").alias("value")
                )
                value = F.col(f"`{shared}`") if shared in self.tables[ref].columns else F.lit(None).cast("string")
                ref_rows = self.tables[ref].select(
                    F.col(id_field(target)).alias("id"), value.alias("value"), INDEX
                )
                matched = assign_matching(
                    table, match["via"], via_rows, ref_rows, parents, self.seed, self.name, fk
                )
                self.flags[fk] = f"_fallback:{fk}"
                return matched.withColumnRenamed(f"{fk}_fallback", self.flags[fk])
        at = draw_parent(self.seed, self.name, fk, F.col(INDEX), parents)
        return table.withColumn(fk, record_id(id_prefix(ref, target), at) if parents else F.lit(None).cast("string"))

    def _copies(self, table: DataFrame, fk: str) -> DataFrame:
        ref = self.links[fk]["ref"]
        wanted = {c: d["field"] for c, d in self.entity.get("copy", {}).items() if d["from"] == fk}
        if not wanted:
            return table
        source = self.tables.get(ref)
        if source is None:
            return table.withColumns({c: F.lit(None).cast("string") for c in wanted})
        present = {c: f for c, f in wanted.items() if f in source.columns}
        absent = {c: F.lit(None).cast("string") for c in wanted if c not in present}
        if present:
            table = copy_fields(table, fk, source, id_field(self.spec["entities"][ref]), present)
        return table.withColumns(absent) if absent else table


def validate_entities(tables: dict[str, DataFrame], spec: dict) -> DataFrame:
    """``(entity, valid, errors)`` of the final rows: content, ids, keys and copies."""
    return union(
        [
            validation_counts(tables[name], full_fields(spec, name)).select(
                F.lit(name).alias("entity"), "valid", "errors"
            )
            for name in spec["entities"]
        ]
    )


def linked_fallbacks(tables: dict[str, DataFrame], spec: dict) -> DataFrame | None:
    """``(entity, fk, fallbacks)`` of any tables: rows whose matched key has no parent with the same value.

    For tables in the making ``generate_with_fallbacks`` has the counts already.

    A row counts if the row behind it is known and no parent shares its value (null matches null). Rows are
    counted by the key they go through before anything is joined. None if no relationship is matched.
    """
    parts = []
    for name, entity in spec["entities"].items():
        links = entity.get("relationships", {})
        for fk, link in links.items():
            match = link.get("match")
            behind = links.get((match or {}).get("via"), {}).get("ref")
            if not match or behind not in tables or link["ref"] not in tables:
                continue
            shared = match["field"]
            if shared not in tables[behind].columns:
                continue
            per_key = tables[name].groupBy(F.col(f"`{match['via']}`").alias("_via")).agg(F.count(F.lit(1)).alias("_rows"))
            known = tables[behind].select(
                F.col(id_field(spec["entities"][behind])).alias("_via"), F.col(f"`{shared}`").alias("_want")
            )
            wanted = per_key.join(known, "_via")
            parents = tables[link["ref"]]
            if shared in parents.columns:
                offered = parents.select(F.col(f"`{shared}`").alias("_value")).distinct()
                wanted = wanted.join(offered, F.col("_want").eqNullSafe(F.col("_value")), "left_anti")
            else:
                wanted = wanted.filter(F.col("_want").isNotNull())
            lost = wanted.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("fallbacks"))
            parts.append(lost.select(F.lit(name).alias("entity"), F.lit(fk).alias("fk"), "fallbacks"))
    return union(parts) if parts else None


def all_violations(tables: dict[str, DataFrame], spec: dict) -> DataFrame | None:
    """``(entity, row, fk, value, ref)`` over all relationships; None if the spec has none."""
    found = [
        fk_violations(
            tables[name],
            name,
            INDEX,
            fk,
            tables[link["ref"]],
            id_field(spec["entities"][link["ref"]]),
            link["ref"],
        )
        for name, entity in spec["entities"].items()
        for fk, link in entity.get("relationships", {}).items()
    ]
    return union(found) if found else None


def evaluate_entities(
    tables: dict[str, DataFrame],
    spec: dict,
    options: EvaluationOptions = EvaluationOptions(),
    responses: dict[str, DataFrame] | None = None,
) -> DataFrame | None:
    """Long rows ``(section=entity, metric, item, value, detail)`` for entities that ask for it.

    Near-duplicates are only counted: removing a row would orphan the rows that refer to it.
    """
    parts: list[DataFrame] = []
    for name, entity in spec["entities"].items():
        labels: Sequence[str] = entity.get("label_fields", [])
        text = entity.get("text_field")
        if text:
            pairs = near_duplicate_count(
                tables[name], INDEX, text, options.dedup_threshold, options.stop_words
            )
            parts.append(metric(pairs, name, "near_duplicate_pairs", None, F.col("pairs")))
            measured = diversity_report(
                tables[name], INDEX, text, labels, options.ngram_n, options.stop_words
            )
        elif labels:
            measured = label_stats(tables[name], labels)
        else:
            measured = None
        if measured is not None:
            parts.append(metric(measured, name, F.col("metric"), F.col("item"), F.col("value")))
        if entity.get("judge") and name in (responses or {}):
            dimensions = entity["judge"]["dimensions"]
            means = judge_means(parse_scores(responses[name], INDEX, dimensions), dimensions)
            judged = [
                (name, "judged", None, F.col("judged"), None),
                (name, "judge_overall_mean", None, F.col("overall_mean"), None),
            ]
            parts.append(metric_rows(means, judged))
    return union(parts) if parts else None


def linked_report(
    tables: dict[str, DataFrame],
    spec: dict,
    quality: DataFrame | None = None,
    first_violations: int | None = None,
) -> DataFrame:
    """Report rows ``(section, metric, item, value, detail)`` of a generation run.

    All integrity violations are listed, or the ``first_violations`` by entity, key and row.
    """
    checked = validate_entities(tables, spec)
    violations = all_violations(tables, spec)
    entity, valid, errors = F.col("entity"), F.col("valid"), F.col("errors")
    parts = [
        metric_rows(
            checked,
            [
                ("entities", "rows", entity, valid + errors, None),
                ("entities", "valid", entity, valid, None),
                ("entities", "errors", entity, errors, None),
            ],
        )
    ]
    if violations is not None:
        violations = stage(violations, "violations")
        broken = F.col("n")
        status = F.when(broken == 0, F.lit("PASS")).otherwise(F.lit("REVIEW"))
        parts.append(
            metric(violations.agg(F.count(F.lit(1)).alias("n")), "integrity", "violations", None, broken, status)
        )
        where = F.concat_ws(".", "entity", "fk")
        about = F.concat(F.coalesce("value", F.lit("null")), F.lit(" -> "), "ref")
        shown = violations
        if first_violations is not None:
            shown = violations.orderBy("entity", "fk", "row").limit(first_violations)
        parts.append(metric(shown, "integrity", "violation", where, F.col("row"), about))
    if quality is not None:
        parts.append(quality)
    return union(parts)
