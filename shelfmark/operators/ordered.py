"""Row numbers and running sums over a total order, without one-task windows.

A window over the whole table, or over one hot key, runs in a single task. Here the rows are
range-partitioned on (keys, order), so a hot key is cut into many ranges. Every range counts its
own rows, and the counts of earlier ranges (one small row per range and key) are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import scratch

_PART_BITS = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits


def _ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    columns = [F.col(k) for k in keys] + list(order)
    placed = (
        df.repartitionByRange(*columns).sortWithinPartitions(*columns)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    # Settled, because the partition numbers must be the same for both readers below.
    placed = scratch.settle(placed)
    return placed.withColumn("_part", F.shiftright("_at", _PART_BITS)).withColumn(
        "_pos", F.col("_at").bitwiseAND(F.lit((1 << _PART_BITS) - 1))).drop("_at")


def _earlier(keys: Sequence[str], column: str) -> Column:
    """Sum of ``column`` over the earlier ranges of the same key: at most one row per range."""
    window = _ranges_of(keys).orderBy("_part")
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0))


def _ranges_of(keys: Sequence[str]):
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on (range, keys) where a null key equals a null key."""
    right = right.select(F.col("_part").alias("_r_part"),
                         *[F.col(k).alias(f"_r_{k}") for k in keys],
                         *[c for c in right.columns if c != "_part" and c not in keys])
    condition = F.col("_part") == F.col("_r_part")
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(right, condition).drop("_r_part", *[f"_r_{k}" for k in keys])


def number_rows(df: DataFrame, order: Sequence[Column], keys: Sequence[str] = (),
                name: str = "row_no") -> DataFrame:
    """Add 1, 2, 3, ... in ``order``, restarting for every value of ``keys``.

    ``order`` has to be a total order within a key for the numbers to be repeatable.
    """
    keys = list(keys)
    placed = _ranges(df, keys, order)
    sizes = placed.groupBy("_part", *keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    starts = sizes.withColumn("_before", _earlier(keys, "_n")).drop("_n")
    if not keys:
        starts = F.broadcast(starts)  # one row per range
    numbered = _same(placed, starts, keys)
    return numbered.select(
        *df.columns, (F.col("_pos") - F.col("_first") + F.col("_before") + 1).alias(name))


def running_sum(df: DataFrame, value: str, order: Sequence[Column], keys: Sequence[str] = (),
                name: str = "running", total: str | None = None) -> DataFrame:
    """Add the sum of ``value`` over this row and all earlier rows of the same key.

    With ``total`` the sum over all rows of the key is added under that name, too.
    """
    keys = list(keys)
    placed = _ranges(df, keys, order)
    sums = placed.groupBy("_part", *keys).agg(F.sum(value).alias("_sum"))
    starts = sums.withColumn("_before", _earlier(keys, "_sum"))
    if total:
        starts = starts.withColumn(total, F.sum("_sum").over(_ranges_of(keys)))
    starts = starts.drop("_sum")
    if not keys:
        starts = F.broadcast(starts)
    inside = Window.partitionBy("_part", *keys).orderBy("_pos")
    summed = placed.withColumn("_inside", F.sum(value).over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return _same(summed, starts, keys).select(
        *df.columns, (F.coalesce(F.col("_inside"), F.lit(0)) + F.col("_before")).alias(name),
        *([total] if total else []))
