"""What the conversation operators share: keys, a total order and narrow stand-ins for turns.

Rows of one conversation follow by turn (null first), then role, then the first 64 characters of
the text, then its digest; only rows that are equal in all of these are left, and those are
interchangeable. Ordering, numbering and comparing thus need no whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLANKS = " \t\n\v\f\r"
HEAD = 64
ORDER = ["_turn", "role", "_head", "_digest"]


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text; the last two not null) with the key columns.

    ``_conv`` and ``_turn`` wrap a nullable value in a struct, which can be joined and grouped on
    like any value: null equals null and comes first.
    """
    return rows.withColumns({
        "_conv": F.struct("conv_id"), "_turn": F.struct("turn"),
        "_head": F.substring("text", 1, HEAD),
        "_digest": F.unhex(F.md5(F.encode("text", "utf-8")))})


def is_blank(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS)) == ""


def last_character(text: Column) -> Column:
    """The last character that is no white space; empty where there is none."""
    return F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))
