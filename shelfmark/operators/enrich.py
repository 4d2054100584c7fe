"""Lookups, fills and merges between record tables.

The lookup side is first made unique on its key with an explicit rule, then joined through
``skew.lookup``, which stays balanced when one key dominates the records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from . import dedup
from .skew import lookup, members


def unfinished(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose id is not in the done set (resume)."""
    return members(df, done, [key], keep=False)


def chosen(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose id was asked for."""
    return members(df, ids, [key], keep=True)


def not_found(ids: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Ids asked for that no row has. Both sides are one row per id, so no id is heavy."""
    return ids.select(key).distinct().join(df.select(key).distinct(), key, "left_anti")


def fill_missing(df: DataFrame, source: DataFrame, key: str, column: str,
                 gate: Column | None = None) -> DataFrame:
    """Take ``column`` from ``source`` (unique on ``key``) where it is empty.

    ``gate`` limits the filling to rows for which it holds.
    """
    found = lookup(df, source.select(key, F.col(column).alias("_new")), [key])
    empty = F.coalesce(F.col(column), F.lit("")) == ""
    if gate is not None:
        empty = empty & gate
    return found.withColumn(column, F.when(
        empty, F.coalesce(F.col("_new"), F.col(column))).otherwise(F.col(column))).drop("_new")


def overwrite(df: DataFrame, source: DataFrame, key: str, column: str, seq: str) -> DataFrame:
    """Replace ``column`` on the first row of every id that ``source`` knows.

    The old value goes even when the new list is shorter. Later rows of the same id stay.
    """
    return _update_first(df, source, key, column, seq, only_when=F.lit(True)).drop("_state")


def fill_first_match(df: DataFrame, source: DataFrame, key: str, column: str, seq: str,
                     is_empty: Column) -> DataFrame:
    """Set ``column`` on the first row of every known id if it is still empty there.

    Adds ``state``: updated, skipped (already filled) or untouched.
    """
    return _update_first(df, source, key, column, seq, is_empty).withColumnRenamed(
        "_state", "state")


def _update_first(df: DataFrame, source: DataFrame, key: str, column: str, seq: str,
                  only_when: Column) -> DataFrame:
    firsts = df.groupBy(key).agg(F.min(seq).alias(seq))
    news = firsts.join(source.select(key, F.col(column).alias("_new")), key)
    news = news.filter(F.col("_new").isNotNull())
    # Neither join has a heavy key: one row per id above, one per (id, seq) here.
    joined = df.join(news, [key, seq], "left")
    hit = F.col("_new").isNotNull()
    return joined.select(
        *[F.when(hit & only_when, F.col("_new")).otherwise(F.col(column)).alias(column)
          if c == column else F.col(c) for c in df.columns],
        F.when(hit & only_when, "updated").when(hit, "skipped").otherwise("untouched")
        .alias("_state"))


def update_counts(updated: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: updated, skipped and not-found counts of a ``fill_first_match``."""
    states = updated.agg(F.count_if(F.col("state") == "updated").alias("updated"),
                         F.count_if(F.col("state") == "skipped").alias("skipped"))
    missing = not_found(source, updated, key).agg(F.count(F.lit(1)).alias("notfound"))
    return states.select("*", missing.scalar().alias("notfound"))


def merge_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer merge of two partial tables; values of the right side win."""
    shared = [c for c in left.columns if c in right.columns and c != key]
    others = [c for c in right.columns if c not in left.columns]
    renamed = right.select(key, *[F.col(c).alias(f"_r_{c}") for c in shared], *others)
    merged = left.join(renamed, key, "full")
    return merged.select(
        key, *[F.coalesce(F.col(f"_r_{c}"), F.col(c)).alias(c) if c in shared else F.col(c)
               for c in left.columns if c != key], *others)


def drop_hollow(df: DataFrame, ignorable: Sequence[str]) -> DataFrame:
    """Drop rows with no data beyond the ignorable columns."""
    telling = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in df.columns
               if c not in ignorable]
    return df.filter(F.coalesce(*telling).isNotNull())


def keep_failed(df: DataFrame, extracted: DataFrame, key: str) -> DataFrame:
    """Add extracted columns; a row whose extraction failed stays, with nulls."""
    return lookup(df, extracted, [key])


def title_lookup(names: DataFrame, catalogue: DataFrame, title: str, id_column: str,
                 url: Column, seq: str) -> DataFrame:
    """Catalogue id and URL by exact trimmed title; the last catalogue row of a title wins.

    ``names`` holds distinct titles. Unmatched ones keep a null id, so matched and missing come
    from one pass.
    """
    entries = catalogue.select(F.trim(F.col(title)).alias(title), F.col(id_column),
                               url.alias("url"), F.col(seq).alias("_seq"))
    entries = dedup.last_wins(entries.filter(F.col(title) != ""), [title], "_seq").drop("_seq")
    return names.join(entries, title, "left")


def first_by_spelling(target: DataFrame, scope: Sequence[str], name: str,
                      spellings: Sequence[Column], position: str,
                      payload: Sequence[str]) -> DataFrame:
    """Lookup table (scope, name) -> payload of the first target row spelled that way.

    Matching a name against any of several spellings with an OR would force a nested loop.
    Listing the spellings as rows makes it one equality join.
    """
    listed = target.select(
        *scope, position, *payload, F.explode(F.array_distinct(F.array(*spellings))).alias(name))
    listed = listed.filter(F.col(name) != "")
    first = dedup.first_wins(listed, [*scope, name], [F.col(position)]).drop(position)
    return first.withColumn("matched", F.lit(True))


def match_any(df: DataFrame, target: DataFrame, scope: Sequence[str], name: str,
              spellings: Sequence[Column], position: str, payload: Sequence[str]) -> DataFrame:
    """Match ``name`` against any of several spellings of the target; first target row wins."""
    first = first_by_spelling(target, scope, name, spellings, position, payload)
    return lookup(df, first, [*scope, name]).withColumn(
        "matched", F.coalesce(F.col("matched"), F.lit(False)))


def match_by_priority(df: DataFrame, by_id: DataFrame, by_title: DataFrame, id_column: str,
                      title: str, card: str) -> DataFrame:
    """Card from the id map, else from the title map, else a new one is due."""
    one = lookup(df, by_id.select(id_column, F.col(card).alias("_by_id")), [id_column])
    two = lookup(one, by_title.select(title, F.col(card).alias("_by_title")), [title], df)
    return two.select(
        *df.columns, F.coalesce("_by_id", "_by_title").alias(card),
        F.when(F.col("_by_id").isNotNull(), "known_id")
        .when(F.col("_by_title").isNotNull(), "known_title").otherwise("create").alias("action"))
