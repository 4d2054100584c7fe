"""Top-k, rankings, pages and batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import values
from .ordered import number_rows


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows with their rank. Every task cuts its rows to k before they meet."""
    whole = Window.partitionBy(F.lit(0)).orderBy(*order)    # over the k rows that are left
    return df.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(whole))


def union_of_rankings(df: DataFrame, key: str, rankings: Sequence[tuple[str, str]],
                      per_ranking: int, page_rows: int = values.API_PAGE_ROWS,
                      max_rows: int | None = None) -> DataFrame:
    """Distinct keys reached by walking the first ``per_ranking`` rows of several rankings one after
    the other.

    Returns ``key``, ``ranking`` (0-based, where it was first met) and ``rank``. With
    ``max_rows`` the walk ends at the first page boundary where that many keys are known, so the
    last page read may go beyond it. Repeated rankings add nothing and are read once.
    """
    first_use: dict[tuple[str, str], int] = {}
    for number, ranking in enumerate(rankings):
        first_use.setdefault(ranking, number)
    # One narrow scan per ranking; each cuts to its first rows by itself.
    walked = []
    for (column, direction), number in first_use.items():
        value = F.col(column).cast("double")
        scored = df.select(key, (value if direction == "desc" else -value).alias("score"))
        walked.append(top_k(scored, [F.col("score").desc_nulls_last(), F.col(key)], per_ranking)
                      .select(key, F.lit(number).alias("ranking"), "rank"))
    ranked = reduce(DataFrame.unionByName, walked)
    met = ranked.groupBy(key).agg(F.min(F.struct("ranking", "rank")).alias("_met")).select(
        key, "_met.ranking", "_met.rank")
    if max_rows is None:
        return met
    page = F.floor((F.col("rank") - 1) / page_rows)
    # At most (number of rankings x pages) rows, so one task may add them up.
    pages = met.groupBy("ranking", page.alias("page")).agg(F.count(F.lit(1)).alias("_new"))
    before = Window.partitionBy(F.lit(0)).orderBy("ranking", "page").rowsBetween(
        Window.unboundedPreceding, -1)
    read = pages.withColumn("_known", F.coalesce(F.sum("_new").over(before), F.lit(0))).filter(
        F.col("_known") < max_rows).select("ranking", "page")
    return met.withColumn("page", page).join(F.broadcast(read), ["ranking", "page"]).drop("page")


def pages(df: DataFrame, order: Sequence[Column], per_page: int) -> DataFrame:
    """Add a 1-based page number to every row."""
    numbered = number_rows(df, order, name="_n")
    return numbered.withColumn("page", F.floor((F.col("_n") - 1) / per_page) + 1).drop("_n")


def batches(df: DataFrame, order: Sequence[Column],
            size: int = values.ENRICH_BATCH_ROWS) -> DataFrame:
    """Add a 0-based batch number for fixed groups of rows."""
    numbered = number_rows(df, order, name="_n")
    return numbered.withColumn("batch", F.floor((F.col("_n") - 1) / size)).drop("_n")


def rows_from(df: DataFrame, order: Sequence[Column], start: int) -> DataFrame:
    """Rows from the 0-based position ``start`` on."""
    return number_rows(df, order, name="_n").filter(F.col("_n") > start).drop("_n")


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def page_links(pages_df: DataFrame, scope: Sequence[str], page: str) -> DataFrame:
    """For every page, whether the page after it is present (the next-page link)."""
    known = pages_df.select(*scope, page).distinct()
    following = known.select(*scope, (F.col(page) - 1).alias(page),
                             F.col(page).alias("next_page"))
    return known.join(following, [*scope, page], "left")
