"""Record names (``[number] title``) and marked-up descriptions on a board."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import values
from . import text

_SKU = r"[A-Z]+\d{6}[A-Z]\d+"


def make_sku(counter: Column, day: Column, prefix: str = values.SKU_PREFIX,
             letter: str = values.SKU_LETTER) -> Column:
    """prefix + ddMMyy + letter + counter of at least two digits."""
    # lpad alone would cut counters above 99.
    digits = F.when(counter < 100, F.lpad(counter.cast("string"), 2, "0")).otherwise(
        counter.cast("string"))
    return F.concat(F.lit(prefix), day, F.lit(letter), digits)


def make_name(sku: Column, title: Column) -> Column:
    return F.concat(F.lit("["), sku, F.lit("] "), title)


def sku_of(name: Column) -> Column:
    """Number in front of a name in brackets, or a name that is a bare number; else null."""
    bracketed = F.nullif(F.regexp_extract(name, rf"^\[({_SKU})\]", 1), F.lit(""))
    return F.coalesce(bracketed, F.when(text.strip(name).rlike(f"^{_SKU}$"), text.strip(name)))


def title_or_name(name: Column) -> Column:
    """Title after ``[...]``, else the whole name."""
    found = text.filled(F.regexp_extract(text.strip(name), r"^\[.*?\]\s*(.+)$", 1))
    return F.coalesce(found, text.strip(name))


def title_of(name: Column) -> Column:
    """Title after ``[...]``; null without brackets."""
    return text.filled(F.regexp_extract(name, r"(?s)^\[.*?\]\s*(.+)", 1))


def title_after_sku(name: Column) -> Column:
    return text.filled(F.regexp_extract(name, rf"^\[{_SKU}\]\s*(.+)", 1))


def described_title(desc: Column) -> Column:
    """Title line anywhere in a description."""
    return text.filled(F.regexp_extract(desc, r"\*\*Title:\*\*\s*(.+?)(?:\n|$)", 1))


def leading_title(desc: Column) -> Column:
    """Title line at the very start of a description."""
    return text.filled(F.regexp_extract(desc, r"^\*\*Title:\*\*\s*(.+)", 1))


def described_tags(desc: Column) -> Column:
    """Tags block of a description in normal form; null without one."""
    raw = F.nullif(F.regexp_extract(desc, r"(?s)\*\*Tags:\*\*\s*(.+?)(?:\n\n|\z)", 1), F.lit(""))
    return text.normal_tags(raw)


def name_ok(name: Column) -> Column:
    return name.rlike(rf"^\[{_SKU}\] .+")


def desc_ok(desc: Column) -> Column:
    """True when no markup is left in the description."""
    return ~text.contains_any(F.coalesce(desc, F.lit("")),
                              [values.TITLE_MARK, values.TAGS_MARK, values.URL_MARK])


def description(title: Column | None = None, tags: Column | None = None,
                url: Column | None = None) -> Column:
    """Marked-up blocks joined by a blank line, empty ones left out."""
    blocks = [(values.TITLE_MARK, title), (values.TAGS_MARK, tags), (values.URL_MARK, url)]
    return F.concat_ws("\n\n", *[
        F.when(c != "", F.concat(F.lit(f"{mark} "), c)) for mark, c in blocks if c is not None])


def hidden_description(listing_id: Column, url: Column) -> Column:
    """Description of a card for a listing that is gone."""
    return F.concat_ws(
        "\n\n", F.concat(F.lit(f"{values.ID_MARK} "), listing_id),
        F.when(url != "", F.concat(F.lit(f"{values.URL_MARK} "), url)),
        F.lit(f"{values.STATUS_MARK} {values.HIDDEN_STATUS}"))


def card_key(listing_id: Column, title: Column) -> Column:
    """``id — first 60 characters of the title``; 80 characters of the title without an id."""
    return F.when(listing_id != "", F.concat(
        listing_id, F.lit(" — "), F.substring(title, 1, values.CARD_TITLE_CHARS)
    )).otherwise(F.substring(title, 1, 80))
