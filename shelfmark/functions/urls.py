"""URLs and file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import values


def absolute(href: Column, host: str) -> Column:
    """A site-relative link with its host; absolute links as they are."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(host), href))


def clean(href: Column, host: str) -> Column:
    """Query and fragment cut, host added when missing."""
    return absolute(F.regexp_replace(href, r"[?#].*$", ""), host)


def path(url: Column) -> Column:
    """Path of a URL; the query and fragment do not count."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def listing_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/listing/(\d+)", 1), F.lit(""))


def listing_url(known: Column, id_column: Column, host: str) -> Column:
    """The known URL, else one made from the id."""
    return F.coalesce(F.nullif(known, F.lit("")),
                      F.concat(F.lit(f"{host}/listing/"), id_column))


def file_name(url: Column) -> Column:
    return F.substring_index(F.substring_index(url, "/", -1), "?", 1)


def extension(url: Column) -> Column:
    """Extension with its dot, ``.jpg`` when there is none."""
    found = F.regexp_extract(file_name(url), r"^.+(\.[^.]*)$", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(".jpg"))


def saved_name(position: Column, url: Column) -> Column:
    return F.concat(F.lit("image_"), position.cast("string"), extension(url))


def mime(name: Column) -> Column:
    ending = F.lower(F.regexp_extract(name, r"(\.[^./]*)$", 1))
    return F.coalesce(*[F.when(ending == e, F.lit(m)) for e, m in values.MIME_TYPES.items()],
                      F.lit(values.MIME_DEFAULT))


def is_local(source: Column) -> Column:
    return ~source.rlike("^https?://")


def stem(name: Column) -> Column:
    return F.regexp_replace(F.substring_index(name, "/", -1), r"(?<=.)\.[^.]*$", "")


def number_in(name: Column) -> Column:
    """First number in a file name, 0 without one: the natural sort key."""
    return F.coalesce(F.regexp_extract(F.substring_index(name, "/", -1), r"(\d+)", 1)
                      .try_cast("bigint"), F.lit(0))


def id_before(stem_column: Column, suffix: str) -> Column:
    """Listing id of ``{id}{suffix}``; null when the stem does not end that way."""
    return F.nullif(F.regexp_extract(stem_column, f"^(.+){suffix}$", 1), F.lit(""))


def leading_id(stem_column: Column) -> Column:
    """Leading digits followed by an underscore; null otherwise."""
    return F.nullif(F.regexp_extract(stem_column, r"^(\d+)_", 1), F.lit(""))
