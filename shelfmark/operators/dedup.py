"""Which of several rows with the same key survives.

``first_wins`` and friends rank rows with ``row_number`` and keep rank 1. Spark then places a
group limit below the shuffle, so every task sends at most one row per key and a hot key costs
no more than a cold one. The orders given must be total, else the survivor is not repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .skew import lookup


def first_wins(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key in ``order``. Null keys form one group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_per_id(df: DataFrame, id_column: str, order: Sequence[Column]) -> DataFrame:
    """``first_wins`` after dropping rows without an id (null or empty)."""
    return first_wins(df.filter(F.col(id_column) != ""), [id_column], order)


def last_wins(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Keep the latest row of each key, as a lookup map filled in sequence does."""
    return first_wins(df, keys, [F.col(seq).desc()])


def longest_wins(df: DataFrame, keys: Sequence[str], items: str,
                 arrival: Sequence[Column]) -> DataFrame:
    """Keep the row with the most items; among equals the earliest arrival."""
    return first_wins(df, keys, [F.size(items).desc(), *arrival])


def later_pass_wins(df: DataFrame, key: str, pass_no: str, found: Column,
                    tie: Sequence[Column] = ()) -> DataFrame:
    """Keep the last pass that found something; the first pass when none did."""
    rows = df.filter(F.col(key) != "").withColumn("_found", F.coalesce(found, F.lit(False)))
    order = [F.col("_found").desc(), F.when(F.col("_found"), -F.col(pass_no)).otherwise(
        F.col(pass_no)), *tie]
    return first_wins(rows, [key], order).drop("_found")


def latest_with_count(df: DataFrame, key: str, day: Column, arrival: Sequence[str],
                      count_name: str = "review_count") -> DataFrame:
    """Latest row per key (rows without a day last, then earliest arrival) and the group size.

    One aggregation with a partial step: no window and no join back. Rows with a null key are
    one group, but their count is null.
    """
    order = F.struct(F.coalesce(-F.unix_date(day), F.lit(2147483647)).alias("_day"), *arrival)
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(
        F.min_by(F.struct(*rest), order).alias("_row"), F.count(F.lit(1)).alias("_n"))
    return best.select(
        key, *[F.col("_row")[c].alias(c) for c in rest],
        F.when(F.col(key).isNotNull(), F.col("_n")).alias(count_name))


def prefix_until_repeat(df: DataFrame, group: str, seq: str, item: str) -> DataFrame:
    """Per group, the rows before the first item comes round again.

    The first item is the first non-empty one. The walk stops at the first row carrying it that
    is not the very first row of the group. A row without an item never stops the walk.
    """
    known = F.when(F.col(item) != "", F.col(seq))
    bounds = df.groupBy(group).agg(
        F.min(seq).alias("_start"), F.min_by(item, known).alias("_item"))
    marked = lookup(df, bounds, [group])
    stops = marked.groupBy(group).agg(
        F.min(F.when((F.col(item) == F.col("_item")) & (F.col(seq) > F.col("_start")),
                     F.col(seq))).alias("_stop"))
    return (
        lookup(df, stops, [group])
        .filter(F.col("_stop").isNull() | (F.col(seq) < F.col("_stop"))).drop("_stop")
    )
