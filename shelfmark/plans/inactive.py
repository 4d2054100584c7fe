"""Review exports -> latest review per item -> items without a review since a cutoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, urls
from ..operators import dedup


def latest_reviews(reviews: DataFrame, arrival: list[str], url: str = "url",
                   data: str = "data") -> DataFrame:
    """One row per item URL: its latest review, the review count, the listing id and the day."""
    found = reviews.withColumn("_part", dates.review_date_part(F.col(data)))
    dated = found.withColumn("review_day", dates.review_day(F.col("_part")))
    best = dedup.latest_with_count(dated, url, F.col("review_day"), arrival)
    # Only the surviving rows need the text forms.
    return best.withColumn("listing_id", urls.listing_id(F.col(url))).withColumn(
        "review_date", dates.review_day_text(F.col("_part"), F.col("review_day"))).drop("_part")


def inactive(latest: DataFrame, day: Column, cutoff: str) -> DataFrame:
    """Items whose latest day lies before the cutoff. Rows without a day are never inactive."""
    return latest.filter(day < F.lit(cutoff).cast("date"))


def activity_counts(latest: DataFrame, day: Column, cutoff: str) -> DataFrame:
    """One row: total, hidden, active. Rows without a day count as active."""
    hidden = F.count_if(day < F.lit(cutoff).cast("date"))
    return latest.agg(F.count(F.lit(1)).alias("total"), hidden.alias("hidden"),
                      (F.count(F.lit(1)) - hidden).alias("active"))


def hidden_table(latest: DataFrame, cutoff: str, shop: str) -> DataFrame:
    """The hidden-listing table made from ``latest_reviews``."""
    return inactive(latest, F.col("review_day"), cutoff).select(
        F.lit(shop).alias("shop_name"), "listing_id", "title", F.lit("").alias("tags"),
        F.col("image").alias("image_1"), F.col("url").alias("etsy_url"), "review_count",
        F.col("review_date").alias("last_review_date"))
