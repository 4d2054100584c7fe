"""Numbers given to records: per day, across runs, and where a run has to resume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, names
from .ordered import number_rows, running_sum


def number_per_day(df: DataFrame, created: Column, order: Sequence[Column],
                   title: Column) -> DataFrame:
    """Add day code, counter within the board day, and the name that follows from them."""
    dated = df.withColumn("day", F.to_date(created))
    counted = number_rows(dated, order, ["day"], "counter")
    return counted.withColumn("expected_name", names.make_name(
        names.make_sku(F.col("counter"), dates.day_code(F.col("day"))), title))


def next_counter(cards: DataFrame, name: str, order: Sequence[str], today: Column) -> DataFrame:
    """One row ``counter``: after the last card's number if it is from today, else 1."""
    last = cards.agg(F.max_by(F.col(name), F.struct(*order)).alias("last"))
    number = F.regexp_extract("last", r"^\[?[A-Z]+\d{6}[A-Z](\d+)\]?", 1).try_cast("bigint")
    day = F.regexp_extract("last", r"^\[?[A-Z]+(\d{6})[A-Z]\d+\]?", 1)
    return last.select(F.coalesce(F.when(day == today, number + 1), F.lit(1).cast("bigint"))
                       .alias("counter"))


def shop_offsets(shops: DataFrame, order: Sequence[Column], total: str,
                 uploaded: str) -> DataFrame:
    """Rows before each shop, its 1-based resume row, and the run's resume point.

    ``reached`` holds while all shops so far are complete; the resume point of the run is the
    end of that stretch plus what the next shop already has.
    """
    summed = running_sum(shops, total, order, name="_upto")
    summed = summed.withColumn("start", F.col("_upto") - F.col(total)).drop("_upto")
    short = F.when(F.col(uploaded) < F.col(total), 1).otherwise(
        F.when(F.col(uploaded) == 0, 1).otherwise(0))
    flagged = running_sum(summed.withColumn("_short", short), "_short", order, name="_shorts")
    return flagged.withColumn("complete", F.col("_short") == 0).withColumn(
        "reached", F.col("_shorts") - F.col("_short") == 0).withColumn(
        "resume_row", F.col("start") + F.col(uploaded) + 1).drop("_short", "_shorts")


def resume_point(offsets: DataFrame, total: str, uploaded: str) -> DataFrame:
    """One row ``resume_at``: number of rows already uploaded without a gap."""
    done = F.col("start") + F.least(F.col(uploaded), F.col(total))
    return offsets.agg(F.coalesce(F.max(F.when(F.col("reached"), done)), F.lit(0))
                       .alias("resume_at"))
