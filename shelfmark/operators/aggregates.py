"""Summaries of logs, boards and measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import values
from .ordered import number_rows, running_sum
from .skew import lookup


def status_counts(df: DataFrame, status: str, elapsed: str,
                  failed: Sequence[str] = ("failed",), by: Sequence[str] = ()) -> DataFrame:
    """done / skipped / failed counts and the mean time of done rows, 0 without any."""
    is_done = F.col(status) == "done"
    return df.groupBy(*by).agg(
        F.count_if(is_done).alias("done"),
        F.count_if(F.col(status) == "skipped").alias("skipped"),
        F.count_if(F.col(status).isin(*failed)).alias("failed"),
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.avg(F.when(is_done, F.col(elapsed))), F.lit(0.0)).alias("mean_elapsed"))


def done_rows(df: DataFrame, status: str) -> DataFrame:
    """Rows whose status is done."""
    return df.filter(F.col(status) == "done")


def found_counts(df: DataFrame, images: Column) -> DataFrame:
    """Rows with and without an image, and the largest number of images."""
    size = F.size(F.coalesce(images, F.array().cast("array<string>")))
    return df.agg(F.count_if(size > 0).alias("found"), F.count_if(size == 0).alias("missing"),
                  F.coalesce(F.max(size), F.lit(0)).cast("bigint").alias("most_images"))


def count_per_group(groups: DataFrame, rows: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Row count of every group, 0 for groups without rows."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return groups.join(counts, key, "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))


def with_group_size(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Every row with the number of rows of its key; null for a null key.

    Counted with a partial step and looked up again: a window over a hot key would bring all
    its rows into one task.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return lookup(df, counts, [key])


def progress(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row: distinct ids in all, those done and those remaining."""
    ids = todo.select(key).filter(F.col(key).isNotNull()).distinct()
    finished = done.select(key).distinct().withColumn("_done", F.lit(True))
    return ids.join(finished, key, "left").agg(
        F.count(F.lit(1)).alias("total"), F.count("_done").alias("done"),
        F.count_if(F.col("_done").isNull()).alias("remaining"))


def groups_in_order(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Distinct keys with the place they first appear at and their row count."""
    return df.groupBy(key).agg(F.min(seq).alias("first_at"), F.count(F.lit(1)).alias("n"))


def items_in_order(df: DataFrame, key: str, item: str, order: Sequence[Column]) -> DataFrame:
    """All items of every key as rows (key, item, position from 1): a list of any length."""
    return number_rows(df, order, [key], "position").select(key, item, "position")


def first_items(df: DataFrame, key: str, item: str, order: Sequence[Column],
                most: int) -> DataFrame:
    """Array of the first ``most`` items per key, in order; ``items_in_order`` has all of them.

    The rank limit works below the shuffle, so a key never sends more than ``most`` rows per
    task, and the arrays are small by construction.
    """
    window = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= most)
    return ranked.groupBy(key).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("_rank", item))), lambda s: s[item]).alias("items"))


def distinct_items(df: DataFrame, key: str, item: str, order: Sequence[str]) -> DataFrame:
    """One row per key and distinct item, placed where the item first occurs.

    The union of a key's lists stays a table (key, item, first place), because a key may own any
    number of items.
    """
    return df.groupBy(key, item).agg(F.min(F.struct(*order)).alias("_at")).select(
        key, item, *[F.col("_at")[c].alias(c) for c in order])


def fallback_names(df: DataFrame, primary: str, fallback: str, name: str = "name") -> DataFrame:
    """Distinct names: the primary column, or the fallback where that is empty."""
    pick = F.coalesce(F.nullif(F.trim(F.col(primary)), F.lit("")),
                      F.nullif(F.trim(F.col(fallback)), F.lit("")))
    return df.select(pick.alias(name)).filter(F.col(name).isNotNull()).distinct()


def exact_median(df: DataFrame, key: str, value: str, least: int = 1) -> DataFrame:
    """Exact median per key with at least ``least`` values, any group size.

    Values are counted first, then a running count finds the middle, so a key with very many
    values is never held in one task.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(
        F.count(F.lit(1)).alias("_n"))
    sized = running_sum(counts, "_n", [F.col(value)], [key], "_upto", total="n").filter(
        F.col("n") >= least)

    def covers(position: Column) -> Column:
        return (F.col("_upto") >= position) & (F.col("_upto") - F.col("_n") < position)

    low, high = F.floor((F.col("n") + 1) / 2), F.floor((F.col("n") + 2) / 2)
    return sized.groupBy(key).agg(
        F.max("n").alias("n"),
        ((F.max(F.when(covers(low), F.col(value))) + F.max(F.when(covers(high), F.col(value))))
         / 2).alias("median"))


def robust_tilt(segments: DataFrame, key: str, x1: str, y1: str, x2: str, y2: str) -> DataFrame:
    """Median tilt per key in degrees, from line segments.

    Upright and zero-width segments do not count; angles are folded into [-45, 45). A key needs
    enough segments both before and after that filter.
    """
    enough = segments.groupBy(key).agg(F.count(F.lit(1)).alias("_all")).filter(
        F.col("_all") >= values.MIN_SEGMENTS)
    angle = F.degrees(F.atan2(F.col(y2) - F.col(y1), F.col(x2) - F.col(x1)))
    kept = segments.filter(F.col(x1) != F.col(x2)).select(key, angle.alias("angle")).filter(
        F.abs(F.col("angle")) <= values.STEEP_DEGREES)
    folded = kept.select(key, (F.pmod(F.col("angle") + 45, F.lit(90.0)) - 45).alias("angle"))
    medians = exact_median(folded, key, "angle", values.MIN_SEGMENTS)
    return medians.join(enough, key, "left_semi").select(
        key, "n", F.round("median", 1).alias("tilt"))


