"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets an exponential key (Efraimidis and Spirakis): -ln(u) / quality weight with u
drawn from a digest of its id, so that reruns agree. A source whose budget exceeds its size gives
complete epochs first; the rest of the budget goes to the documents with the least keys, found by
a prefix sum of sizes over the keys' order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .prefix import with_prefix

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
_PLAIN_MARKS = "0123456789#$%&*|!<>{}[]=_~^@+/\\"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORDS)), F.lit(0)).cast("long")


def plain_share(text: str = "text") -> Column:
    """Quality weight: 0.1 plus the share of the text that is not digits or marks; empty: 0.1."""
    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = F.length(F.translate(column, _PLAIN_MARKS, ""))
    return F.lit(0.1) + F.when(F.length(column) > 0, kept / F.length(column)).otherwise(0.0)


def draw(*columns: Column) -> Column:
    """A number in (0, 1] from the columns' digest."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in columns])
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 1) / float(1 << 48)


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Target of every source: ``share`` of all sizes split by weight, each at most ``most`` times
    the source's size and the excess reshared by weight.

    ``sizes`` has one row per source: source, source_size. Filling by weight stops at the caps in
    the order of cap / weight, so the level of the open ones follows from two running sums.
    The windows run over one row per source, not over documents.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int"))
    ranked = (sizes.withColumn("_no", number).withColumn("_w", weight)
              .withColumn("_cap", F.col("source_size") * most))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), "_no")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * share
              - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after))
    # The first source in this order that stays under its cap fixes the level of all later ones.
    leveled = ranked.withColumn("_open", F.when(level * F.col("_w") <= F.col("_cap"), level))
    fixed = F.first("_open", ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, 0))
    return leveled.select("source", "source_size", "_no", F.coalesce(
        fixed * F.col("_w"), F.col("_cap")).alias("target"))


def mix(df: DataFrame, size: Column, quality: Column, identity: Sequence[Column],
        source: str = "source", weights: Sequence[float] = WEIGHTS, share: float = 1.5,
        most: float = 2.0) -> DataFrame:
    """Add size, source_size, target, times (how often the document is taken) and taken.

    ``identity`` are the columns that tell documents apart; they feed the random draw and break
    ties. Null sources form one source, ordered last. Documents of size 0 take nothing beyond the
    complete epochs. Equal rows share a draw but are counted one by one. Input columns with the
    names of the added ones are replaced.
    """
    added = ["size", "source_size", "target", "times", "taken"]
    df = df.drop(*[c for c in added if c != source]).withColumn("size", size).withColumn(
        "_key", -F.log(draw(*identity)) / F.greatest(quality, F.lit(1e-6)))
    if source != "source":
        df = df.withColumn("source", F.col(f"`{source}`"))
    sizes = df.groupBy("source").agg(F.sum("size").alias("source_size"))
    planned = targets(sizes, weights, share, most).withColumnRenamed("source", "_source")
    rows = df.join(planned, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = with_prefix(rows, {"_before": F.col("size")},
                       [F.col("_key"), *identity], keys=["_no"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
                    ).otherwise(0)
    left = F.col("target") - epochs * F.col("source_size")
    # Whole documents only: the one on the edge is taken if that brings the sum nearer.
    chosen = (left - F.col("_before")) * 2 >= F.col("size")
    return (rows.withColumn("times", (epochs + F.when(chosen & (left > 0), 1).otherwise(0)
                                      ).cast("long"))
            .withColumn("taken", F.col("size") * F.col("times"))
            .drop("_no", "_key", "_before", "_before_all"))


def repeat(mixed: DataFrame) -> DataFrame:
    """One row for every time a document is taken."""
    return mixed.withColumn("_time", F.explode(
        F.when(F.col("times") > 0, F.sequence(F.lit(1).cast("long"), F.col("times"))))).drop("_time")
