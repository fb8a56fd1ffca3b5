"""Seeded draws that depend only on (seed, entity, field, row).

Nothing here uses ``rand`` or ``monotonically_increasing_id``: a draw is a hash of what it is
for, so a recomputed task, another partitioning or another engine gives the same value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_BITS = 52
_SPAN = float(1 << DRAW_BITS)


def draw_bits(seed: int, entity: str, field: str, row: Column) -> Column:
    """52 uniform bits as a bigint."""
    key = F.concat_ws("|", F.lit(str(seed)), F.lit(entity), F.lit(field), row.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def draw_unit(seed: int, entity: str, field: str, row: Column) -> Column:
    """A double in [0, 1)."""
    return draw_bits(seed, entity, field, row) / F.lit(_SPAN)


def draw_below(seed: int, entity: str, field: str, row: Column, size: Column | int) -> Column:
    """An integer in [0, size); ``size`` may be a column."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.floor(draw_unit(seed, entity, field, row) * size.cast("double")).cast("bigint")


def draw_between(seed: int, entity: str, field: str, row: Column, low: int, high: int) -> Column:
    """An integer in [low, high], both ends included."""
    return F.lit(low).cast("bigint") + draw_below(seed, entity, field, row, high - low + 1)


def draw_choice(seed: int, entity: str, field: str, row: Column, values: Sequence) -> Column:
    """One of ``values``; a repeated value is drawn proportionally more often."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (draw_below(seed, entity, field, row, len(values)) + 1).cast("int"))


def cumulative_shares(weights: Sequence[float]) -> list[float]:
    """Upper ends of the unit interval's slices, one per weight."""
    total = float(sum(weights))
    ends, running = [], 0.0
    for weight in weights:
        running += float(weight)
        ends.append(running / total)
    return ends


def draw_weighted(
    seed: int, entity: str, field: str, row: Column, values: Sequence[str], weights: Sequence[float]
) -> Column:
    """One of ``values`` with probability proportional to its weight; weight 0 is never drawn."""
    unit = draw_unit(seed, entity, field, row)
    drawable = [(v, e) for v, e, w in zip(values, cumulative_shares(weights), weights) if w > 0]
    last = drawable[-1][0]
    picked = None
    for value, end in drawable[:-1]:
        test = unit < F.lit(end)
        picked = F.when(test, F.lit(value)) if picked is None else picked.when(test, F.lit(value))
    return F.lit(last) if picked is None else picked.otherwise(F.lit(last))
