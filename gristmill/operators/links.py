"""Links between tables: children per parent, drawn foreign keys, copied fields, integrity checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.draws import draw_below, draw_between
from gristmill.operators.indexing import BUCKET_ROWS, rank_in_group, running_offsets

# Rows of one group that are ranked in one task.
PIECE = 100_000


def children_of(
    parents: DataFrame, index: str, rows: int, low: int, high: int, seed: int, entity: str, keep: Sequence[str]
) -> DataFrame:
    """``(keep..., _child, _idx)``: low..high children per parent, densely numbered in parent order.

    ``parents`` has the dense ``index`` 0..rows-1. A fixed number of children needs no shuffle; else
    numbers are summed per bucket of parents, and only inside a bucket row by row.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    parent = F.col(index)
    if low == high:
        made = parents.select(*kept, parent.alias("_p"), F.lit(low).cast("bigint").alias("_k"))
        made = made.withColumn("_start", F.col("_p") * low)
    else:
        drawn = draw_between(seed, entity, "children", parent, low, high)
        bucket = F.floor(parent / F.lit(BUCKET_ROWS)).cast("bigint")
        made = parents.select(*kept, parent.alias("_p"), drawn.alias("_k"), bucket.alias("_b"))
        totals = made.groupBy("_b").agg(F.sum("_k").alias("_sum"))
        offsets = running_offsets(totals, "_b", "_sum", "_offset")
        so_far = Window.partitionBy("_b").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
        made = made.withColumn("_upto", F.sum("_k").over(so_far)).join(offsets, "_b")
        made = made.withColumn("_start", F.col("_offset") + F.col("_upto") - F.col("_k"))
    born = made.filter(F.col("_k") > 0).select(
        *kept, "_start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_k") - 1)).alias("_child")
    )
    return born.select(*kept, "_child", (F.col("_start") + F.col("_child")).alias("_idx"))


def draw_parent(seed: int, entity: str, fk: str, row: Column, parents: int) -> Column:
    """Dense index of a uniformly drawn parent; null if there are no parents."""
    if parents == 0:
        return F.lit(None).cast("bigint")
    return draw_below(seed, entity, f"fk:{fk}", row, parents)


def assign_matching(
    children: DataFrame,
    via: str,
    via_parents: DataFrame,
    parents: DataFrame,
    parent_count: int,
    seed: int,
    entity: str,
    fk: str,
    row: str = "_idx",
) -> DataFrame:
    """Add ``fk`` drawn among the parents that share a value with the row behind ``via``.

    ``via_parents``: ``(id, value)``, unique ids. ``parents``: ``(id, value, _idx)`` with dense ``_idx``.
    ``<fk>_fallback`` is true where no parent shares the value and any parent was drawn instead; where
    ``via`` leads nowhere any parent is drawn too, which is no fallback. Null matches null.

    Every parent has two addresses, its rank among those with the same value and its place among all,
    and one join resolves whichever a child has drawn. Values shared by many parents are ranked in
    pieces, and the drawn ranks spread a popular value's children over the join's tasks.
    """
    sizes = parents.groupBy(F.col("value").alias("_v")).agg(F.count(F.lit(1)).alias("_size"))
    behind = via_parents.join(sizes, via_parents["value"].eqNullSafe(sizes["_v"]), "left").select(
        F.col("id").alias("_via"),
        F.lit(True).alias("_known"),
        F.col("value").alias("_want"),
        "_size",
    )
    placed = children.join(behind, children[via] == behind["_via"], "left").drop("_via")
    matched = F.col("_size").isNotNull()
    at = F.when(matched, draw_below(seed, entity, f"fk:{fk}", F.col(row), F.col("_size"))).otherwise(
        draw_parent(seed, entity, f"{fk}:any", F.col(row), parent_count)
    )
    placed = placed.select(
        *[f"`{c}`" for c in children.columns],
        matched.alias("_m"),
        F.when(matched, F.col("_want")).alias("_w"),
        at.alias("_at"),
        (F.coalesce("_known", F.lit(False)) & ~matched & F.lit(parent_count > 0)).alias(f"{fk}_fallback"),
    )
    ranked = rank_in_group(parents, "value", "_idx", PIECE, "_rank")
    value, nothing = F.col("value"), F.lit(None).cast(ranked.schema["value"].dataType)
    by_rank = F.struct(F.lit(True).alias("_am"), value.alias("_aw"), F.col("_rank").alias("_aa"))
    by_place = F.struct(F.lit(False).alias("_am"), nothing.alias("_aw"), F.col("_idx").alias("_aa"))
    addresses = ranked.select(F.col("id").alias(fk), F.inline(F.array(by_rank, by_place)))
    same = (
        (placed["_m"] == addresses["_am"])
        & (placed["_at"] == addresses["_aa"])
        & placed["_w"].eqNullSafe(addresses["_aw"])
    )
    joined = placed.join(addresses, same, "left")
    return joined.select(*[f"`{c}`" for c in children.columns], fk, f"{fk}_fallback")


def fallback_count(children: DataFrame, fk: str) -> DataFrame:
    """One row ``(fk, fallbacks)``."""
    return children.agg(F.count_if(F.col(f"{fk}_fallback")).alias("fallbacks")).select(
        F.lit(fk).alias("fk"), "fallbacks"
    )


def first_by_key(table: DataFrame, key: str, position: str, columns: Sequence[str]) -> DataFrame:
    """One row per key, the first by position. Aggregated before the shuffle, so copies of a key are cheap."""
    first = F.min_by(F.struct(*[f"`{c}`" for c in columns]), position).alias("_first")
    return table.filter(F.col(key).isNotNull()).groupBy(key).agg(first).select(key, "_first.*")


def copy_fields(
    children: DataFrame, fk: str, parents: DataFrame, parent_id: str, columns: dict[str, str]
) -> DataFrame:
    """Add parent columns (``{new name: parent column}``) by foreign key; unresolved gives null.

    ``parents`` has unique ids (see ``first_by_key``).
    """
    source = parents.select(
        F.col(parent_id).alias("_ref"), *[F.col(f"`{c}`").alias(new) for new, c in columns.items()]
    )
    return children.join(source, children[fk] == source["_ref"], "left").drop("_ref")


def fk_violations(
    child: DataFrame, entity: str, position: str, fk: str, parent: DataFrame, parent_id: str, ref: str
) -> DataFrame:
    """``(entity, row, fk, value, ref)`` of every key that is null or names no parent.

    Only the distinct key values meet the parents. The unresolved ones, normally few, are then looked
    up in the child table, so that neither a popular key nor many nulls load one task.
    """
    known = parent.select(F.col(parent_id).alias("_key")).filter(F.col("_key").isNotNull())
    used = child.select(F.col(fk).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    unresolved = used.join(known, "_key", "left_anti")
    dangling = child.join(unresolved, child[fk] == unresolved["_key"], "left_semi")
    bad = child.filter(F.col(fk).isNull()).select(position, fk).unionAll(dangling.select(position, fk))
    return bad.select(
        F.lit(entity).alias("entity"),
        F.col(position).alias("row"),
        F.lit(fk).alias("fk"),
        F.col(fk).cast("string").alias("value"),
        F.lit(ref).alias("ref"),
    )


def duplicate_keys(table: DataFrame, *key: str) -> DataFrame:
    """``(key..., count)`` of keys that are null or occur more than once."""
    null_key = F.lit(False)
    for column in key:
        null_key = null_key | F.col(column).isNull()
    counts = table.groupBy(*key).agg(F.count(F.lit(1)).alias("count"))
    return counts.filter((F.col("count") > 1) | null_key)
