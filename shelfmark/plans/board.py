"""Desired listings against the cards of a board -> a table of actions.

Nothing is sent anywhere: a plan says what to create, refresh, rename or skip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, names, text
from ..operators import enrich
from ..operators.numbering import number_per_day
from ..operators.ordered import running_sum
from ..operators.skew import lookup


def _matched(listings: DataFrame, cards: DataFrame, spellings: Sequence[Column]) -> DataFrame:
    """Listings with the card they match and the first listing of the same shop and title.

    A listing whose title came earlier in the run meets the card made for that earlier one.
    """
    titled = listings.withColumn("title", text.first_filled(F.col("title"), F.col("listing_id")))
    target = cards.select(
        F.col("list_name").alias("shop_name"), "pos", F.col("id").alias("card_id"),
        F.col("desc").alias("old_desc"), "attachment_count", *[
            s.alias(f"_spelling_{i}") for i, s in enumerate(spellings)])
    keys = ["shop_name", "title"]
    on_board = enrich.first_by_spelling(
        target, ["shop_name"], "title", [F.col(f"_spelling_{i}") for i in range(len(spellings))],
        "pos", ["card_id", "old_desc", "attachment_count"])
    # One row per shop and title on either side, so this join has no heavy key, and the listings
    # need a single lookup.
    firsts = titled.groupBy(*keys).agg(
        F.min("seq").alias("_first_seq"), F.min_by("new_desc", "seq").alias("_first_desc"))
    both = lookup(titled, firsts.join(on_board, keys, "left"), keys)
    both = both.withColumn("matched", F.coalesce(F.col("matched"), F.lit(False)))
    made = ~F.col("matched") & (F.col("seq") > F.col("_first_seq"))
    return both.withColumn("old_desc", F.when(made, F.col("_first_desc")).otherwise(
        F.col("old_desc"))).withColumn("attachment_count", F.when(made, 0).otherwise(
            F.col("attachment_count"))).withColumn(
        "exists", F.col("matched") | made).drop("_first_seq", "_first_desc")


def _numbered(plan: DataFrame, listings: DataFrame, first_counter: int) -> DataFrame:
    """Counter each row would use: it moves on after every create and reattach.

    Shops are worked through in the order they first appear in.
    """
    shops = listings.groupBy("shop_name").agg(F.min("seq").alias("_shop_at"))
    ordered = lookup(plan, shops, ["shop_name"], listings).withColumn(
        "_counts", F.col("action").isin("create", "reattach").cast("bigint"))
    run = running_sum(ordered, "_counts", [F.col("_shop_at"), F.col("seq")], name="_upto")
    return run.withColumn("counter", F.col("_upto") - F.col("_counts") + first_counter).drop(
        "_upto", "_counts", "_shop_at")


def upload_plan(listings: DataFrame, cards: DataFrame, first_counter: int = 1) -> DataFrame:
    """create / reattach / skip per listing, and whether its description needs an update.

    listings: shop_name, listing_id, title, tags, n_images, seq.
    cards: list_name, id, name, desc, attachment_count, pos.
    """
    wanted = listings.withColumn("new_desc", F.coalesce(text.strip(F.col("tags")), F.lit("")))
    rows = _matched(wanted, cards, [names.title_of(F.col("name")), F.col("name")])
    enough = F.col("attachment_count") >= F.col("n_images")
    planned = rows.withColumn("action", F.when(~F.col("exists"), "create").when(
        enough, "skip").otherwise("reattach"))
    stale = ~(names.desc_ok(F.col("old_desc")) & (
        F.coalesce(F.col("old_desc"), F.lit("")) == F.col("new_desc")))
    return _numbered(planned.withColumn("update_desc", F.col("exists") & stale),
                     listings, first_counter)


def upload_plan_any(listings: DataFrame, cards: DataFrame, first_counter: int = 1) -> DataFrame:
    """Variant: any attachment is enough; cards are known by the title in their description.

    listings additionally: url.
    """
    wanted = listings.withColumn("new_desc", names.description(
        text.first_filled(F.col("title"), F.col("listing_id")), F.col("tags"), F.col("url")))
    rows = _matched(wanted, cards, [names.leading_title(F.col("desc")), F.col("name")])
    planned = rows.withColumn("action", F.when(~F.col("exists"), "create").when(
        F.col("attachment_count") > 0, "skip").otherwise("reattach"))
    return _numbered(planned, listings, first_counter)


def upload_plan_by_name(listings: DataFrame, card_names: DataFrame,
                        name: str = "name") -> DataFrame:
    """Variant: skip when a card of the composite name exists, else create."""
    keyed = listings.withColumn(name, names.card_key(F.col("listing_id"), F.col("title")))
    known = card_names.select(name).distinct().withColumn("_known", F.lit(True))
    return lookup(keyed, known, [name]).withColumn(
        "action", F.when(F.col("_known"), "skip").otherwise("create")).drop("_known")


def hidden_cards(hidden: DataFrame, card_names: DataFrame) -> DataFrame:
    """Cards for listings that are gone: name, description, create or skip."""
    return upload_plan_by_name(hidden, card_names).withColumn(
        "desc", names.hidden_description(F.col("listing_id"), F.col("etsy_url")))


def name_audit(cards: DataFrame, tags_by_title: DataFrame | None = None) -> DataFrame:
    """What is wrong with each card's name and description, and what they should be.

    ``outcome``: no_sku, no_title, ok, added_from_csv, or the parts that need an update. With
    ``tags_by_title`` (title, csv_tags, unique on title) an empty description is filled from it.
    """
    parsed = (
        cards.withColumn("desc", F.coalesce("desc", F.lit("")))
        .withColumn("sku", names.sku_of(F.col("name")))
        .withColumn("title", names.described_title(F.col("desc")))
        .withColumn("new_name", names.make_name(F.col("sku"), F.col("title")))
        .withColumn("new_desc", F.coalesce(names.described_tags(F.col("desc")), F.lit(""))))
    empty = F.lit(False)
    if tags_by_title is not None:
        empty = text.strip(F.col("desc")) == ""
        parsed = parsed.withColumn(
            "title", F.when(empty, names.title_after_sku(F.col("name"))).otherwise(
                F.col("title")))
        parsed = lookup(parsed, tags_by_title, ["title"])
    name_good = names.name_ok(F.col("name")) & (F.col("name") == F.col("new_name"))
    desc_good = names.desc_ok(F.col("desc")) & (F.col("desc") == F.col("new_desc"))
    outcome = F.when(F.col("sku").isNull(), "no_sku")
    if tags_by_title is not None:
        outcome = outcome.when(empty & F.col("csv_tags").isNotNull(), "added_from_csv").when(
            empty, "no_title")
    outcome = (outcome.when(F.col("title").isNull(), "no_title")
               .when(name_good & desc_good, "ok")
               .when(~name_good & ~desc_good, "name,desc")
               .when(~name_good, "name").otherwise("desc"))
    audited = parsed.withColumn("outcome", outcome)
    renames, rewrites = F.col("outcome").like("%name%"), F.col("outcome").like("%desc%")
    new_desc = F.when(rewrites, F.col("new_desc"))
    if tags_by_title is not None:
        new_desc = F.when(F.col("outcome") == "added_from_csv", F.col("csv_tags")).otherwise(
            new_desc)
    return audited.select(*cards.columns, "sku", "outcome",
                          F.when(renames, F.col("new_name")).alias("new_name"),
                          new_desc.alias("new_desc"))


def tags_by_title(rows: DataFrame, seq: str) -> DataFrame:
    """title -> normalised tags; the last row of a title wins, rows without either are left."""
    kept = rows.select(text.strip(F.col("title")).alias("title"),
                       text.strip(F.col("tags")).alias("tags"), seq).filter(
        (F.col("title") != "") & (F.col("tags") != ""))
    return kept.groupBy("title").agg(
        text.normal_tags(F.max_by("tags", seq)).alias("csv_tags"))


def renumber_plan(cards: DataFrame, created: Column, id_column: str = "id") -> DataFrame:
    """Cards whose name differs from their number of the day and title."""
    timed = cards.withColumn("created_at", created)
    numbered = number_per_day(timed, F.col("created_at"),
                              [F.col("created_at"), F.col(id_column)],
                              names.title_or_name(F.col("name")))
    return numbered.filter(F.col("name") != F.col("expected_name"))


def card_times(cards: DataFrame, action_time: str = "action_time") -> Column:
    """Creation time of cards: the recorded action when known, else the card id."""
    return dates.created_at(F.col(action_time), F.col("id"))
