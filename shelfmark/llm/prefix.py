"""Global prefix sums over an ordered table.

Rows are range-partitioned on (keys, order), so that even one key with a third of all rows is cut
into many ranges. Every range sums its own rows; the sums of earlier ranges, at most one row per
range and key, are added. The ranges are written once to the shared scratch folder, because the
totals and the rows must see the same ranges and because that survives lost executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..scratch import settle

_LOW = 33  # monotonically_increasing_id: partition above, position below


def with_prefix(df: DataFrame, values: dict[str, Column], order: Sequence[Column],
                keys: Sequence[str] = ()) -> DataFrame:
    """Add two columns per entry of ``values``: its sum over all earlier rows of the same key, and
    under the name with _all its sum over all rows of the key.

    ``keys`` must not be null. Rows that ``order`` cannot tell apart follow in the order in which
    the input's partitions hold them. The columns _at, _part and those of ``values`` are reserved.
    """
    columns = [F.col(k) for k in keys] + list(order)
    placed = (df.withColumns({f"_v_{k}": v for k, v in values.items()})
              .withColumn("_tie", F.monotonically_increasing_id())
              .repartitionByRange(*columns, "_tie").sortWithinPartitions(*columns, "_tie")
              .withColumn("_at", F.monotonically_increasing_id()).drop("_tie"))
    placed = settle(placed).withColumn("_part", F.shiftright("_at", _LOW))
    group = ["_part", *keys]
    totals = placed.groupBy(*group).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in values])
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    bases = totals.select(*group, *[F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(
        f"_b_{k}") for k in values], *[F.sum(f"_t_{k}").over(whole).alias(f"{k}_all")
                                       for k in values])
    inside = Window.partitionBy(*group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.join(bases, group)
            .withColumns({k: F.col(f"_b_{k}") + F.coalesce(F.sum(f"_v_{k}").over(inside), F.lit(0))
                          for k in values})
            .drop("_part", "_at", *[f"_{x}_{k}" for x in "vb" for k in values]))
