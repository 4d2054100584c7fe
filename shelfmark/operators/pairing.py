"""Pairing two ordered tables by name, leftovers by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import dedup
from .ordered import number_rows
from .skew import lookup


def pair(fronts: DataFrame, backs: DataFrame, key: str, name: str) -> DataFrame:
    """Columns front, back, how (name / position).

    A front takes the last back with its key. Fronts without one and backs not taken are paired
    in name order; what is left over on the longer side is dropped.
    """
    last_back = dedup.first_wins(backs, [key], [F.col(name).desc()]).select(
        key, F.col(name).alias("back"))
    looked = lookup(fronts, last_back, [key])
    named = looked.filter(F.col("back").isNotNull()).select(
        F.col(name).alias("front"), "back", F.lit("name").alias("how"))

    alone = looked.filter(F.col("back").isNull()).select(F.col(name).alias("front"))
    # A back is taken when a front has its key and it is the last back of that key. Both joins
    # are on columns that are unique on either side.
    taken = last_back.join(fronts.select(key).distinct(), key, "left_semi").select(
        F.col("back").alias(name))
    spare = backs.select(name).join(taken, name, "left_anti").select(F.col(name).alias("back"))
    by_position = number_rows(alone, [F.col("front")], name="_n").join(
        number_rows(spare, [F.col("back")], name="_n"), "_n")
    return named.unionByName(
        by_position.select("front", "back", F.lit("position").alias("how")))
