"""Positions, ranks and exact cuts that never send a whole table or group through one task.

The common idea is two levels: an even bucket of the position, whose sizes form a table of
bounded length, and a window inside each bucket only.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bound on every table of bucket totals, and so on what a single task or the driver sees.
BUCKETS = 4096


# Rows of a bucket of positions; the number of buckets follows the table.
BUCKET_ROWS = 10_000


def running_offsets(totals: DataFrame, bucket: str, amount: str, offset: str) -> DataFrame:
    """``(bucket, offset)``: the sum of ``amount`` over all earlier buckets.

    Two levels: buckets within a run of ``BUCKETS`` of them, and the runs. With ``BUCKET_ROWS`` rows to a
    bucket, one task sees a table of 10^11 rows as 2,500 runs, and no task more than ``BUCKETS`` buckets.
    """
    run = F.floor(F.col(bucket) / BUCKETS).cast("bigint")
    numbered = totals.select(F.col(bucket), F.col(amount).alias("_amount"), run.alias("_run"))
    runs = numbered.groupBy("_run").agg(F.sum("_amount").alias("_sum"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_run", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    earlier = Window.partitionBy("_run").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    inside = numbered.withColumn("_inside", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)))
    joined = inside.join(runs, "_run")
    return joined.select(bucket, (F.col("_before") + F.col("_inside")).cast("bigint").alias(offset))


def dense_index(df: DataFrame, key: str, name: str = "_idx") -> DataFrame:
    """Add the 0-based rank of the unique integer column ``key``.

    Buckets are the ranges between quantiles of the key, so an uneven key still gives buckets of
    about equal size. The boundaries are constants of the plan and the same in every task.
    """
    rows = df.count()
    pieces = min(BUCKETS, max(1, rows // 10_000))
    if pieces == 1:
        return df.withColumn(name, F.row_number().over(Window.orderBy(key)).cast("bigint") - 1)
    shares = [i / pieces for i in range(1, pieces)]
    ends = df.agg(F.percentile_approx(key, shares, 10 * pieces).alias("ends")).first()["ends"]
    splits = [float("-inf"), *sorted({float(end) for end in ends}), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_place", outputCol="_bucket")
    placed = cut.transform(df.withColumn("_place", F.col(key).cast("double"))).drop("_place")
    totals = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = running_offsets(totals, "_bucket", "_rows", "_offset")
    inside = Window.partitionBy("_bucket").orderBy(key)
    ranked = placed.withColumn("_inner", F.row_number().over(inside).cast("bigint") - 1)
    return (
        ranked.join(offsets, "_bucket")
        .withColumn(name, F.col("_offset") + F.col("_inner"))
        .drop("_bucket", "_offset", "_inner")
    )


def rank_in_group(df: DataFrame, group: str, index: str, width: int, rank: str) -> DataFrame:
    """Add the 0-based rank within ``group`` in ``index`` order.

    A group may hold most of the table: it is cut along ``index`` (a dense position) into pieces of
    at most ``width`` rows, ranked apart, and shifted by the sizes of the earlier pieces. Null is a
    group like any other.
    """
    placed = df.withColumn("_piece", F.floor(F.col(index) / F.lit(width)).cast("bigint"))
    sizes = placed.groupBy(group, "_piece").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col(group).alias("_g"),
        F.col("_piece").alias("_p"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"),
    )
    inside = Window.partitionBy(group, "_piece").orderBy(index)
    ranked = placed.withColumn("_inner", F.row_number().over(inside).cast("bigint") - 1)
    same = ranked[group].eqNullSafe(shifts["_g"]) & (ranked["_piece"] == shifts["_p"])
    return (
        ranked.join(shifts, same)
        .withColumn(rank, F.col("_shift") + F.col("_inner"))
        .drop("_piece", "_inner", "_g", "_p", "_shift")
    )


def first_k(df: DataFrame, keys: list[str], k: int) -> Column:
    """A condition true for exactly the first ``k`` rows in the order of the integer ``keys``.

    Together the keys identify a row. At most ``BUCKETS`` counters or keys are fetched at a time, and
    the answer is a comparison with constants: the table itself is neither sorted nor shuffled.
    """
    if k <= 0:
        return F.lit(False)
    chosen, tied, wanted = F.lit(False), F.lit(True), k
    for key in keys:
        found = _nth_smallest(df.filter(tied).select(F.col(key).cast("bigint").alias("_k")), wanted)
        if found is None:
            return F.lit(True)
        value, below, equal = found
        chosen = chosen | (tied & (F.col(key) < F.lit(value)))
        tied = tied & (F.col(key) == F.lit(value))
        wanted -= below
        if equal == wanted:
            break
    return chosen | tied


def _nth_smallest(scope: DataFrame, n: int) -> tuple[int, int, int] | None:
    """The ``n``-th smallest value of ``_k``, the number of rows below it and of rows equal to it.

    A range of values is narrowed down by histograms until few enough rows are left to be fetched, or
    until it is a single value.
    """
    low, high, rows = scope.agg(F.min("_k"), F.max("_k"), F.count("_k")).first()
    if n > rows:
        return None
    below = 0
    while low < high:
        inside = scope.filter((F.col("_k") >= F.lit(low)) & (F.col("_k") <= F.lit(high)))
        if rows <= BUCKETS:
            values = sorted(row["_k"] for row in inside.collect())
            value = values[n - below - 1]
            return value, below + values.index(value), values.count(value)
        width = -(-(high - low + 1) // BUCKETS)
        # The span may exceed a bigint; whole decimals keep the offsets exact.
        offset = f"cast(_k as decimal(38, 0)) - cast({low} as decimal(38, 0))"
        slot = F.expr(f"cast(({offset}) div cast({width} as decimal(38, 0)) as int)").alias("s")
        counts = dict(inside.groupBy(slot).agg(F.count(F.lit(1)).alias("c")).collect())
        for number in sorted(counts):
            if below + counts[number] >= n:
                low, high = low + number * width, min(high, low + (number + 1) * width - 1)
                rows = counts[number]
                break
            below += counts[number]
    return low, below, rows
