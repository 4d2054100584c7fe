"""JSON pages of the search and shop APIs -> typed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import values
from ..functions import labels, metrics, text


def rename(item: str | None, fields: Mapping[str, str],
           present: Sequence[str] | None = None) -> list[Column]:
    """Columns of a rename map; fields that are not present become null."""
    source = (lambda f: F.col(f"{item}.{f}")) if item else F.col
    return [source(f).alias(to) if present is None or f in present
            else F.lit(None).cast("string").alias(to) for f, to in fields.items()]


def arrange(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Columns in the given order, unknown ones after them."""
    known = [c for c in order if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def _as_json(item: str, names: Sequence[str], fields: T.StructType) -> Column:
    """The first of several fields that holds something, as JSON text: services send arrays of objects,
    arrays of texts or bare text under one name, and spell the name in two ways."""
    found = []
    for name in names:
        if name not in fields.fieldNames():
            continue
        value = F.col(f"{item}.{name}")
        if not isinstance(fields[name].dataType, T.StringType):
            value = F.to_json(value)
        found.append(F.when(~F.trim(value).isin("", "[]", "null"), value))
    return F.coalesce(*found, F.lit(None).cast("string"))


def tags_of(item: str, fields: T.StructType, separator: str) -> Column:
    """Tags of an item as one text: an array (also as JSON text) is joined, a text stays as it is."""
    if "tags" not in fields.fieldNames():
        return F.lit(None).cast("string")
    tags = F.col(f"{item}.tags")
    if isinstance(fields["tags"].dataType, T.ArrayType):
        return text.tags_from_array(tags, separator)
    listed = text.tags_from_array(F.from_json(tags, "array<string>"), separator)
    return F.when(F.trim(tags).startswith("["), listed).otherwise(text.filled(tags))


def image_of(images_json: Column, icon: Column) -> Column:
    """First image URL of a JSON array of objects or texts; the icon where there is no array."""
    first = F.get(F.from_json(
        images_json, "array<struct<url_170x135:string,url_fullxfull:string,url:string>>"),
        F.lit(0))
    plain = F.get(F.from_json(images_json, "array<string>"), F.lit(0))
    from_object = text.first_filled(first["url_170x135"], first["url_fullxfull"], first["url"])
    return F.when(images_json.startswith("[") & (images_json != "[]"), F.coalesce(
        from_object, F.when(~plain.startswith("{"), plain))).otherwise(text.filled(icon))


def search_listings(pages: DataFrame, niches: Mapping = {}, sub_niches: Mapping = {}) -> DataFrame:
    """One row per item of ``results``, with derived metrics and labels.

    Expects the fields of the search API as read by ``read.json``; numbers may be texts.
    """
    items = pages.select(F.explode("results").alias("item"))
    fields = items.schema["item"].dataType
    present = fields.fieldNames()

    def field(name: str) -> Column:
        return F.col(f"item.{name}") if name in present else F.lit(None).cast("string")

    mapped = items.select(
        *rename("item", values.SEARCH_FIELDS, present),
        F.coalesce(text.filled(F.col("item.shop.shop_name")) if "shop" in present else
                   F.lit(None).cast("string"), text.filled(field("shop_name"))).alias("shop_name"),
        tags_of("item", fields, "; ").alias("tags"),
        image_of(_as_json("item", ["Images", "images"], fields), field("icon_url_fullxfull")).alias(
            "image_url"))
    unlocked = text.unlock(mapped, values.LOCKED_COLUMNS)

    def number(name: str) -> Column:
        return text.to_number(F.col(name).cast("string"))

    with_metrics = unlocked.withColumn(
        "views_per_month", metrics.views_per_month(number("total_views"), number("listing_age"))
    ).withColumn(
        "engagement_rate", metrics.engagement_rate(number("total_favorites"),
                                                   number("total_views"))
    ).withColumn(
        "competition_score", metrics.competition_score(number("total_reviews"),
                                                       F.col("views_per_month")))
    labelled = with_metrics.withColumn("niche", labels.niche(F.col("tags"), niches)).withColumn(
        "sub_niche", labels.sub_niche(F.col("tags"), F.col("niche"), sub_niches))
    return arrange(labelled, values.SEARCH_ORDER)


def shops(pages: DataFrame) -> DataFrame:
    """One row per page that carries shop details."""
    rows = pages.filter(F.col("shop_details").isNotNull()).select(
        *rename("shop_details", values.SHOP_FIELDS,
                pages.schema["shop_details"].dataType.fieldNames()))
    return arrange(text.unlock(rows), values.SHOP_ORDER)


def shop_listings(pages: DataFrame, shop: Column) -> DataFrame:
    """One row per item of ``results`` under its shop; locked texts become null everywhere."""
    items = pages.select(shop.alias("shop_name"), F.explode("results").alias("item"))
    fields = items.schema["item"].dataType
    # An image is a bare text here; where a service sends a list there is none.
    images = values.SHOP_LISTING_FIELDS["Images"]
    mapped = items.select("shop_name", *rename("item", values.SHOP_LISTING_FIELDS, fields.fieldNames()),
                          tags_of("item", fields, ", ").alias("tags"))
    if isinstance(mapped.schema[images].dataType, T.StringType):
        mapped = mapped.withColumn(images, F.when(~F.col(images).startswith("["), F.col(images)))
    else:
        mapped = mapped.withColumn(images, F.lit(None).cast("string"))
    return arrange(text.unlock(mapped), values.SHOP_LISTING_ORDER)
