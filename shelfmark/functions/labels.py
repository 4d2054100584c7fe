"""Keyword taxonomies: the first label any of whose keywords occurs in the tags.

A taxonomy is configuration, a dict written by hand, so it becomes one expression inside the
scan stage: no join and nothing to broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from . import text


def niche(tags: Column, taxonomy: Mapping[str, Sequence[str]]) -> Column:
    lowered = F.lower(tags)
    return F.coalesce(*[
        F.when(text.contains_any(lowered, [w.lower() for w in words]), F.lit(label))
        for label, words in taxonomy.items() if words], F.lit(None).cast("string"))


def sub_niche(tags: Column, niche_column: Column, taxonomy: Mapping[str, Mapping]) -> Column:
    """Like ``niche``; a label with a parent only counts under that niche."""
    lowered = F.lower(tags)
    picks = []
    for label, entry in taxonomy.items():
        if not entry.get("keywords"):
            continue
        hit = text.contains_any(lowered, [w.lower() for w in entry["keywords"]])
        if entry.get("parent"):
            hit = (niche_column == entry["parent"]) & hit
        picks.append(F.when(hit, F.lit(label)))
    return F.coalesce(*picks, F.lit(None).cast("string"))
