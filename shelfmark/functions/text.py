"""Cleaning and splitting text. Empty text is null inside the package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import values

# (?U): Unicode white space, so a no-break space counts as a blank.
_BLANKS = r"(?U)\s+"
_BETWEEN_BLANKS = r"(?sU)^\s*+(.*\S)?"


def strip(c: Column) -> Column:
    return F.regexp_extract(c, _BETWEEN_BLANKS, 1)


def filled(c: Column) -> Column:
    """Stripped text, null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def squeeze(c: Column) -> Column:
    """Inner runs of white space become one blank; null when nothing is left."""
    return F.nullif(squeeze_blanks(c), F.lit(""))


def squeeze_blanks(c: Column) -> Column:
    """``squeeze`` with empty text for nothing."""
    return F.trim(F.regexp_replace(c, _BLANKS, " "))


_NUMBERED = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"


def _numbered_character(reference: Column) -> Column:
    digits = F.regexp_extract(reference, "([0-9a-fA-F]+);", 1)
    code = F.when(F.lower(reference).contains("x"), F.conv(digits, 16, 10)).otherwise(
        digits).cast("bigint")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return (F.when(code == 38, "&amp;")     # resolved with the named ones, and once only
            .when(valid, F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(63))), 8, "0")),
                                  "UTF-32")).otherwise("\ufffd"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def resolved(raw: Column, value: Column | None = None) -> Column:
    """Numbered and the common named character references resolved, in ``raw`` or in ``value``, a part of
    it. ``raw`` is a plain column, for it is named several times; most texts have no reference."""
    value = raw if value is None else value
    done = F.aggregate(F.array_distinct(F.regexp_extract_all(value, F.lit(_NUMBERED), F.lit(0))), value,
                       lambda held, ref: F.replace(held, ref, _numbered_character(ref)))
    for name, character in values.ENTITIES:
        done = F.replace(done, F.lit(f"&{name};"), F.lit(character))
    return F.when(raw.contains("&"), done).otherwise(value)


def nulls_for_blanks(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Null for blank text in every string column, or in those named; other text is kept."""
    strings = {n for n, t in df.dtypes if t == "string"}
    chosen = strings if columns is None else strings & set(columns)
    return df.select(*[F.when(strip(F.col(c)) != "", F.col(c)).alias(c) if c in chosen
                       else F.col(c) for c in df.columns])


def blanks_for_nulls(df: DataFrame) -> DataFrame:
    """Empty text for null in string columns, for text sinks."""
    strings = {n for n, t in df.dtypes if t == "string"}
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in strings else F.col(c)
                       for c in df.columns])


def unlock(df: DataFrame, columns: Iterable[str] | None = None,
           sentinels: Sequence[str] = (values.LOCKED_TEXT,)) -> DataFrame:
    """Null for sentinel texts: in all string columns, or only in the locked ones named."""
    strings = {n for n, t in df.dtypes if t == "string"}
    chosen = strings if columns is None else strings & set(columns)
    return df.select(*[
        F.when(~strip(F.col(c)).isin(*sentinels), F.col(c)).alias(c) if c in chosen
        else F.col(c) for c in df.columns])


def to_number(c: Column) -> Column:
    """Double from text, thousands commas dropped; null when it is not a number."""
    return F.regexp_replace(strip(c), ",", "").try_cast("double")


def to_int(c: Column, default: int) -> Column:
    """Whole number from text, cut towards zero; the default when it is not a number."""
    return F.coalesce(to_number(c).try_cast("int"), F.lit(default))


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*[filled(c) for c in columns])


def contains_any(c: Column, phrases: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(p) for p in phrases])


# Lists held in one text or in an array.

def tags_from_array(tags: Column, separator: str = "; ") -> Column:
    """Trimmed non-empty tags joined; null when none."""
    kept = F.filter(tags, lambda t: t.isNotNull() & (t != ""))
    return F.nullif(F.array_join(F.transform(kept, strip), separator), F.lit(""))


def split_tags(c: Column) -> Column:
    """Array of trimmed non-empty tags of a text separated by semicolons or commas."""
    return F.filter(F.transform(F.split(c, "[;,]"), strip), lambda t: t != "")


def normal_tags(c: Column) -> Column:
    return F.array_join(split_tags(c), ", ")


def distinct_ignoring_case(items: Column) -> Column:
    """First spelling of every item, compared in lower case, order kept."""
    lowered = F.transform(items, lambda t: F.lower(t))
    return F.filter(items, lambda t, i: F.array_position(lowered, F.lower(t)) == i + 1)


def distinct_urls(urls: Column) -> Column:
    """Order-keeping distinct after trailing dots and commas are cut."""
    return F.array_distinct(F.filter(
        F.transform(urls, lambda u: F.regexp_replace(u, r"[.,]+$", "")), lambda u: u != ""))


# Labelled text.

_LABELLED = r"^([^:：]+)[:：]\s*(.+)$"


def label_of(c: Column) -> Column:
    """Label of ``label: value`` (ASCII or full-width colon), else null."""
    return filled(F.regexp_extract(c, _LABELLED, 1))


def value_of(c: Column) -> Column:
    return filled(F.regexp_extract(c, _LABELLED, 2))


def value_after(text: Column, label: Column) -> Column:
    """Text with every spelling of the label removed and the leftover marks cut."""
    quoted = F.concat(F.lit(r"(?i)\Q"), label, F.lit(r"\E"))
    return F.nullif(F.regexp_replace(F.regexp_replace(text, quoted, F.lit("")),
                                     r"^[ :\-–—]+|[ :\-–—]+$", ""), F.lit(""))


def label_class(label: Column) -> Column:
    """website / size / industry / address by the words in a label, else null."""
    lowered = F.lower(F.regexp_replace(label, _BLANKS, " "))
    return F.coalesce(*[F.when(contains_any(lowered, words), F.lit(name))
                        for name, words in values.COMPANY_LABELS])


def before_on(c: Column) -> Column:
    """Name part of ``name on date``, cut at the first " on "; whole text without one."""
    at = F.instr(c, " on ")
    return strip(F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c))


def after_on(c: Column) -> Column:
    """Date part of ``name on date``; null without " on "."""
    at = F.instr(c, " on ")
    return F.when(at > 0, filled(F.substring(c, at + 4, F.length(c))))


def leading_digit(c: Column) -> Column:
    """Rating: the leading digit, else the stripped text."""
    return F.coalesce(F.nullif(F.regexp_extract(strip(c), r"^(\d)", 1), F.lit("")), strip(c))


def first_integer(c: Column) -> Column:
    """Age text such as ``17 Mo.``: the first integer, else the stripped text."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")), strip(c))
