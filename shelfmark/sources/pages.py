"""Page tables (page_id, url, html) -> columns, with built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import values
from ..functions import text

_TAG = r"<[^>]*>"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A stored page table: page_id, url, html."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def inner_text(fragment: Column) -> Column:
    """Text of an HTML fragment: tags out, the common entities resolved, blanks squeezed."""
    bare = F.regexp_replace(fragment, _TAG, " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                         ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return text.squeeze(bare)


def page_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles and comments do not count."""
    return inner_text(F.regexp_replace(
        html, r"(?is)<(script|style|template)\b.*?</\1\s*>|<!--.*?-->", " "))


def element_text(html: Column, tag: str) -> Column:
    """Text of the first element with this tag; null without one."""
    return inner_text(F.nullif(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1),
                               F.lit("")))


def hrefs(html: Column) -> Column:
    """Links of all anchors, in order, first occurrences only."""
    return F.array_distinct(F.regexp_extract_all(
        html, F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1)))


def links_with(html: Column, *tokens: str) -> Column:
    """Distinct anchor links that contain every token (host, size)."""
    def fits(link: Column) -> Column:
        hit = F.lit(True)
        for token in tokens:
            hit = hit & link.contains(token)
        return hit
    return F.filter(hrefs(html), fits)


def anchor_rows(html: Column) -> Column:
    """Array of struct(url, title) of list items that hold a titled link.

    A block without a link or without a title gives no row.
    """
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), F.lit(1))
    rows = F.transform(blocks, lambda b: F.struct(
        F.regexp_extract(b, r'(?is)<a\s[^>]*?href="([^"]*)"', 1).alias("url"),
        inner_text(F.regexp_extract(b, r"(?is)<a\s[^>]*>(.*?)</a>", 1)).alias("title")))
    return F.filter(rows, lambda r: (r["url"] != "") & r["title"].isNotNull())


def anchor_titles(html: Column) -> Column:
    """Texts of list-item links joined by "; ", null when there are none."""
    return F.nullif(F.array_join(F.transform(anchor_rows(html), lambda r: r["title"]), "; "),
                    F.lit(""))


def is_gone(status: Column, final_url: Column, lowered: Column, has_h1: Column,
            listing_mark: str = "/listing/") -> Column:
    """Three-valued: true gone, false there, null undecided (bot check or an odd page)."""
    return (F.when(status == 404, True)
            .when(text.contains_any(lowered, values.GONE_PHRASES), True)
            .when(text.contains_any(lowered, values.ROBOT_PHRASES), F.lit(None).cast("boolean"))
            .when(~final_url.contains(listing_mark), True)
            .when(has_h1, False))


def is_gone_live(status: Column, final_url: Column, lowered: Column,
                 listing_mark: str = "/listing/") -> Column:
    """Live rule: redirects first, no bot check; null only when the fetch failed."""
    return (F.when(status.isNull(), F.lit(None).cast("boolean"))
            .when(~final_url.contains(listing_mark), True)
            .when(status == 404, True)
            .when(text.contains_any(lowered, values.LIVE_GONE_PHRASES), True).otherwise(False))


def is_rate_limited(source: Column, phrases: Sequence[str] = values.RATE_LIMIT_PHRASES) -> Column:
    return text.contains_any(source, phrases)


def is_rate_limit_page(html: Column) -> Column:
    """Narrower rule, title first, so that page content does not set it off."""
    title = F.coalesce(F.lower(element_text(html, "title")), F.lit(""))
    return text.contains_any(title, values.RATE_LIMIT_TITLES) | text.contains_any(
        html, values.RATE_LIMIT_MARKS)


def site_name(html: Column, suffix: str) -> Column:
    """Company name: heading, else page-title metadata, else title; site suffix cut."""
    meta = F.regexp_extract(
        html, r'(?is)<meta\s[^>]*property="og:(?:title|site_name)"[^>]*content="([^"]*)"', 1)
    name = F.coalesce(element_text(html, "h1"), text.filled(meta), element_text(html, "title"))
    return F.regexp_replace(name, rf"(?is)\s*\|\s*{suffix}.*$", "")


def json_ld_keywords(html: Column) -> Column:
    """Keywords of the first JSON-LD block as ``a; b; c`` (a text or a list)."""
    body = F.regexp_extract(
        html, r'(?is)<script[^>]*type=[\'"]application/ld\+json[\'"][^>]*>(.*?)</script>', 1)
    raw = F.get_json_object(body, "$.keywords")
    listed = F.from_json(raw, "array<string>")
    return F.when(raw.startswith("["), text.tags_from_array(listed)).otherwise(
        text.filled(F.regexp_replace(raw, r",\s*", "; ")))


def next_page(current: Column, links: Column, arrow: Column) -> Column:
    """The link to the page after the current one, else the arrow link if it names a page."""
    number = F.regexp_extract(current, r"page=(\d+)", 1).try_cast("int")
    onward = F.get(F.filter(links, lambda u: F.regexp_extract(u, r"page=(\d+)", 1)
                            .try_cast("int") == number + 1), F.lit(0))
    return F.coalesce(onward, F.when(arrow.contains("page="), arrow))
