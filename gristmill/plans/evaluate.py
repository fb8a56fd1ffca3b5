"""Full evaluation of a flat dataset and its report rows."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators.diversity import diversity_report
from gristmill.operators.judge import (
    PASS_SCORE,
    is_flagged,
    judge_means,
    judge_prompts,
    judge_sample,
    parse_scores,
    record_mean,
    score_records,
    verdict,
)
from gristmill.operators.neardup import THRESHOLD, removed_and_pairs
from gristmill.operators.validate import field_coverage, invalid_records, valid_records, validation_counts
from gristmill.session import Scope, owned_by, stage

BAR_CELLS = 20

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class EvaluationOptions:
    dedup_threshold: float = THRESHOLD
    ngram_n: int = 2
    judge_sample_size: int | None = None
    pass_score: float = PASS_SCORE
    seed: int = 42
    stop_words: Sequence[str] | None = None
    strict_dates: bool = False
    # Counting the similar pairs verifies those that are not certain; removal does not need it.
    count_pairs: bool = True
    # Without it nothing is judged, whatever the spec says.
    run_judge: bool = True


@dataclass(frozen=True)
class Evaluation:
    """``clean``: records that passed and were kept. ``errors``: rejected ones. ``metrics``: long rows
    ``(section, metric, item, value, detail)``. ``scores``: judged records, if any. ``close()`` drops the
    staged tables that these read, when they are no longer needed."""

    clean: DataFrame
    errors: DataFrame
    metrics: DataFrame
    scores: DataFrame | None = field(default=None)
    scope: Scope | None = field(default=None)

    def close(self) -> None:
        if self.scope is not None:
            self.scope.close()


def metric(df: DataFrame, section: str, name: str | Column, item: Column | None, value: Column, detail=None):
    name = F.lit(name) if isinstance(name, str) else name
    nothing = F.lit(None).cast("string")
    return df.select(
        F.lit(section).alias("section"),
        name.alias("metric"),
        (nothing if item is None else item.cast("string")).alias("item"),
        value.cast("double").alias("value"),
        (nothing if detail is None else detail).alias("detail"),
    )


def metric_rows(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """Several metrics ``(section, metric, item, value, detail)`` out of every row of ``df``, in one pass."""
    structs = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit(name).alias("metric"),
            (F.lit(item) if item is None or isinstance(item, str) else item).cast("string").alias("item"),
            value.cast("double").alias("value"),
            (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
        )
        for section, name, item, value, detail in rows
    ]
    return df.select(F.inline(F.array(*structs)))


def evaluate(
    records: DataFrame,
    spec: dict,
    position: str,
    options: EvaluationOptions = EvaluationOptions(),
    score: Callable[[pd.DataFrame], Sequence[str]] | None = None,
    responses: DataFrame | None = None,
) -> Evaluation:
    """Validate, find near-duplicates, deduplicate, measure, judge and give a verdict.

    ``position`` is the integer order column; valid records whose position is null or repeated are refused,
    as removal would take them for one. Judging needs the spec's ``judge`` block and either
    ``score``, called on prompts, or ``responses`` ``(position, raw)`` made elsewhere.
    """
    scope = Scope(records.sparkSession)
    with owned_by(scope):
        found = _evaluated(records, spec, position, options, score, responses)
    return replace(found, scope=scope)


def _check_positions(records: DataFrame, position: str) -> None:
    """Raise unless every record has a position of its own."""
    uses = records.groupBy(F.col(position).alias("place")).agg(F.count(F.lit(1)).alias("n"))
    wrong = uses.filter(F.col("place").isNull() | (F.col("n") > 1)).first()
    if wrong is not None:
        what = "no value" if wrong["place"] is None else f"value {wrong['place']}"
        raise ValueError(f"positions must be unique: {wrong['n']} valid records have {what} in {position!r}")


def _evaluated(
    records: DataFrame,
    spec: dict,
    position: str,
    options: EvaluationOptions,
    score: Callable[[pd.DataFrame], Sequence[str]] | None,
    responses: DataFrame | None,
) -> Evaluation:
    fields, text = spec["fields"], spec["text_field"]
    strict = {"strict_dates": options.strict_dates}
    errors = invalid_records(records, fields, position, **strict)
    valid = stage(valid_records(records, fields, [position], **strict), "valid")
    _check_positions(valid, position)

    gone, pairs = removed_and_pairs(
        valid, position, text, options.dedup_threshold, options.stop_words, options.count_pairs
    )
    clean = stage(valid.join(gone.select(F.col("id").alias(position)), position, "left_anti"), "clean")

    counts = validation_counts(records, fields, **strict)
    coverage = field_coverage(valid, list(fields))
    sizes = clean.agg(F.count(F.lit(1)).alias("kept"))
    diversity = diversity_report(
        clean, position, text, spec["label_fields"], options.ngram_n, options.stop_words
    )
    valid_count, error_count = F.col("valid"), F.col("errors")
    parts = [
        metric_rows(
            counts,
            [
                ("summary", "input_records", None, valid_count + error_count, None),
                ("summary", "valid_records", None, valid_count, None),
                ("validation", "errors", None, error_count, None),
            ],
        ),
        metric(sizes, "summary", "clean_records", None, F.col("kept")),
        metric(gone.agg(F.count(F.lit(1)).alias("n")), "summary", "duplicates_removed", None, F.col("n")),
        metric(coverage, "validation", "coverage", F.col("field"), F.col("coverage")),
        *([metric(pairs, "dedup", "pairs", None, F.col("pairs"))] if pairs is not None else []),
        metric(sizes, "dedup", "threshold", None, F.lit(options.dedup_threshold)),
        metric(diversity, "diversity", F.col("metric"), F.col("item"), F.col("value")),
    ]

    judge = spec.get("judge") if options.run_judge else None
    if judge and score is None and responses is None:
        log.warning("%s has a judge block but neither a score function nor responses: nothing is judged", spec["name"])
    scores = None
    if judge and (score is not None or responses is not None):
        dimensions = judge["dimensions"]
        chosen = judge_sample(clean, position, options.judge_sample_size, options.seed)
        if responses is None:
            raw = score_records(judge_prompts(chosen, position), position, score)
        else:
            raw = responses.join(chosen.select(position), position, "left_semi")
        scores = stage(parse_scores(raw, position, dimensions), "scores")
        summary = judge_means(scores, dimensions)
        judged, overall = F.col("judged"), F.col("overall_mean")
        passed = verdict(judged, overall, options.pass_score)
        parts.append(
            metric_rows(
                summary,
                [
                    ("judge", "judged", None, judged, None),
                    *[("judge", "mean", d, F.col(f"`{d}`"), None) for d in dimensions],
                    ("judge", "overall_mean", None, overall, None),
                    ("judge", "flagged", None, F.col("flagged"), None),
                    ("verdict", "verdict", None, F.lit(None), passed),
                ],
            )
        )
    else:
        parts.append(metric(sizes, "verdict", "verdict", None, F.lit(None), F.lit("PASS")))
    return Evaluation(clean, errors, union(parts), scores)


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def bar(share: Column, cells: int = BAR_CELLS) -> Column:
    """A bar of filled and empty cells; halves round to even."""
    filled = F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * cells, 0).cast("int")
    return F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(cells) - filled))


def quality_report(result: Evaluation, spec: dict, position: str, flagged: int | None = None) -> DataFrame:
    """Report rows ``(section, metric, item, value, detail)`` for reading.

    Coverage and label rows carry a bar, and flagged records are named by their first field: all of them,
    or the first ``flagged``.
    Within a metric the largest values come first, so labels read by descending count.
    """
    labels = result.metrics.filter(F.col("metric").startswith("label:"))
    totals = labels.groupBy("metric").agg(F.sum("value").alias("total"))
    rest = result.metrics.filter(~F.col("metric").startswith("label:"))
    covered = F.when(F.col("metric") == "coverage", bar(F.col("value"))).otherwise(F.col("detail"))
    parts = [
        rest.withColumn("detail", covered),
        labels.join(totals, "metric").select(
            "section", "metric", "item", "value", bar(F.col("value") / F.col("total")).alias("detail")
        ),
    ]
    if result.scores is not None:
        parts.append(flagged_rows(result.scores, result.clean, spec, position, flagged))
    return union(parts).orderBy("section", "metric", F.desc("value"), "item")


def flagged_rows(
    scores: DataFrame, records: DataFrame, spec: dict, position: str, first: int | None = None
) -> DataFrame:
    """Flagged records: name, issue and scores of all, or of the first ones by position."""
    dimensions = spec["judge"]["dimensions"]
    shown = scores.filter(is_flagged(dimensions))
    if first is not None:
        shown = shown.orderBy(position).limit(first)
    display = next(iter(spec["fields"]))
    named = shown.join(records.select(position, F.col(f"`{display}`").cast("string").alias("_name")), position)
    marks = F.concat_ws("/", *[F.concat(F.lit(d[:1]), F.col(f"`{d}`").cast("string")) for d in dimensions])
    issue = F.when(F.col("issue") == "", F.lit("low score")).otherwise(F.col("issue"))
    name = F.coalesce(F.nullif(F.col("_name"), F.lit("")), F.lit("(record)"))
    return metric(
        named, "judge", "flagged_record", name, record_mean(dimensions), F.concat_ws(" ", issue, marks)
    )
