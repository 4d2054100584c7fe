"""Contiguous shards of near-equal byte size.

Rows keep a global order; the size of everything before a row decides its shard. Sizes are summed
per range of that order, the ranges' totals give each range its start, and the whole is cut at
equal targets. A row belongs to the shard in which its middle byte falls, so shards differ by at
most one row's size from the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .prefix import with_prefix


def byte_size(text: str = "text") -> Column:
    """UTF-8 bytes and one for the line end; a null text is the line end alone."""
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1).cast("long")


def shard_by_bytes(df: DataFrame, size: Column, order: Sequence[Column],
                   shards: int = 8) -> DataFrame:
    """Add ``shard`` (0 to shards - 1, contiguous in ``order``) and ``slot`` (0, 1, ... in a shard).

    ``size`` is a non-null positive long. Nulls in ``order`` come first; rows it cannot tell apart
    follow in input order. An empty table gives an empty result. Input columns named shard, slot or
    with a leading underscore and one of the names used here are replaced.
    """
    df = df.drop("shard", "slot").withColumn("_size", size)
    rows = with_prefix(df, {"_before": F.col("_size"), "_row": F.lit(1).cast("long")}, order)
    middle = (F.col("_before") * 2 + F.col("_size")).cast("decimal(38,0)")
    rows = rows.withColumn("shard", F.least(
        F.floor(middle * shards / (F.col("_before_all") * 2)), F.lit(shards - 1)).cast("int"))
    firsts = rows.groupBy("shard").agg(F.min("_row").alias("_first"))  # at most one row per shard
    return (rows.join(F.broadcast(firsts), "shard")
            .withColumn("slot", F.col("_row") - F.col("_first"))
            .select(*[c for c in df.columns if c != "_size"], "shard", "slot"))
