"""Content of generated rows: drawn values, recombined pools, scenario overlays."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.draws import (
    draw_below,
    draw_between,
    draw_bits,
    draw_choice,
    draw_weighted,
)
from gristmill.operators.indexing import first_k
from gristmill.spec import enum_values, enum_weights, scenario_size

INDEX = "_idx"


def drawn_value(seed: int, entity: str, field: str, rule: dict, row: Column, purpose: str = "") -> Column:
    """A field's value for one row; ``purpose`` separates draws for the same field."""
    label, kind = f"{purpose}{field}", rule.get("type", "str")
    if kind == "int":
        if rule.get("choices"):
            return draw_choice(seed, entity, label, row, [int(v) for v in rule["choices"]]).cast("bigint")
        low = int(rule.get("ge", 0))
        return draw_between(seed, entity, label, row, low, int(rule.get("le", low + 100)))
    if kind == "enum":
        values = enum_values(rule)
        if rule.get("weights"):
            return draw_weighted(seed, entity, label, row, values, enum_weights(rule))
        return draw_choice(seed, entity, label, row, values)
    if kind == "date":
        anchor = str(rule.get("anchor", "today"))
        start = date.today() if anchor == "today" else date.fromisoformat(anchor)
        ends = sorted((int(rule.get("min_offset_days", 0)), int(rule.get("max_offset_days", 0))))
        days = draw_between(seed, entity, label, row, *ends).cast("int")
        return F.date_add(F.lit(start), days).cast("string")
    return F.concat(F.lit(f"{field}_"), (row + 1).cast("string"))


def synthetic_columns(seed: int, entity: str, fields: dict, row: Column) -> list[Column]:
    """One drawn column per content field; optional fields are filled like the others."""
    return [drawn_value(seed, entity, name, rule, row).alias(name) for name, rule in fields.items()]


def recombine(
    rows: DataFrame,
    pool: DataFrame,
    pool_size: int,
    seed: int,
    entity: str,
    strategy: str = "sample",
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Give every row of ``rows`` (by ``_idx``) content drawn from ``pool`` with replacement.

    ``sample`` draws whole pool rows. ``shuffle`` draws a pool row, then draws each listed field (all by
    default) again on its own. ``pool`` has a dense ``_idx``; drawn indexes are uniform, so the joins
    are even, and a small pool is broadcast on its measured size.
    """
    content = [c for c in pool.columns if c != INDEX]
    redrawn = list(fields or content) if strategy == "shuffle" else []
    kept = [c for c in content if c not in redrawn]
    row, result = F.col(INDEX), rows
    if kept:
        at = draw_below(seed, entity, "pool", row, pool_size)
        source = pool.select(F.col(INDEX).alias("_pick"), *[f"`{c}`" for c in kept])
        result = result.withColumn("_pick", at).join(source, "_pick").drop("_pick")
    for field in redrawn:
        at = draw_below(seed, entity, f"pool:{field}", row, pool_size)
        source = pool.select(F.col(INDEX).alias("_pick"), f"`{field}`")
        result = result.withColumn("_pick", at).join(source, "_pick").drop("_pick")
    return result.select(*rows.columns, *[f"`{c}`" for c in content])


def overlay_scenarios(
    table: DataFrame, rows: int, scenarios: Sequence[dict], seed: int, entity: str
) -> DataFrame:
    """Overwrite fields on exactly as many rows as each scenario asks for, in order.

    ``table`` has the dense ``_idx`` 0..rows-1. Which rows are hit follows from their drawn numbers
    alone, so the cut is found on a bare range and applied as a filter condition.
    """
    spark = table.sparkSession
    row = F.col(INDEX)
    for number, scenario in enumerate(scenarios):
        k = scenario_size(scenario, rows)
        if k == 0:
            continue
        bits = draw_bits(seed, entity, f"scenario:{number}", row)
        chosen = first_k(spark.range(rows).toDF(INDEX).withColumn("_h", bits), ["_h", INDEX], k)
        types = dict(table.dtypes)
        changes = {}
        for field, value in scenario["set"].items():
            if isinstance(value, dict) and "type" in value:
                new = drawn_value(seed, entity, field, value, row, purpose=f"scenario:{number}:")
            else:
                new = F.lit(value)
            if field in types:
                # A literal of another type is kept, so that validation can report it: the column is text then.
                kind = types[field] if isinstance(value, dict) or _fits(value, types[field]) else "string"
                changes[field] = F.when(chosen, new.cast(kind)).otherwise(F.col(f"`{field}`").cast(kind))
            else:
                changes[field] = F.when(chosen, new)
        table = table.withColumn("_h", bits).withColumns(changes).drop("_h")
    return table


def _fits(value: object, kind: str) -> bool:
    """Whether a literal of a scenario can be read as a value of a column's type."""
    if value is None or kind not in ("bigint", "int"):
        return True
    try:
        return int(str(value) if not isinstance(value, bool) else value) is not None
    except ValueError:
        return False


def record_id(prefix: str, row: Column) -> Column:
    """``PREFIX-0001`` for row 0; grows past four digits."""
    return F.format_string(f"{prefix}-%04d", row + 1)
