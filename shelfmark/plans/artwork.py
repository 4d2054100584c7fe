"""Work lists around artwork: what to extract, what to compose, what was produced."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import values
from ..functions import artwork, text, urls
from ..operators import dedup
from ..operators.aggregates import first_items
from ..operators.skew import lookup, members

MAX_MOCKUPS = 1000


def arts_of_ids(files: DataFrame, ids: DataFrame) -> DataFrame:
    """Art files (path) of the listings asked for: ``{id}`` or ``{id}_...`` as file stem.

    Every beginning of a stem that ends before an underscore and has as many underscores as some id
    is looked up, so the match is an equality join whatever the ids look like.
    """
    return members(id_candidates(files, ids), ids, ["listing_id"]).groupBy("path").agg(
        F.min("listing_id").alias("listing_id"))


def id_candidates(files: DataFrame, ids: DataFrame) -> DataFrame:
    """path, listing_id: what could be an id in front of a file's stem."""
    sizes = ids.select(F.collect_set(F.size(F.split("listing_id", "_")))).scalar()  # as an id's length at most
    parts = F.split(urls.stem(F.col("path")), "_")
    stems = files.select("path", parts.alias("_parts"), F.explode(
        F.array_intersect(F.sequence(F.lit(1), F.size(parts)), sizes)).alias("_size"))
    return stems.select("path", F.array_join(F.slice("_parts", F.lit(1), F.col("_size")), "_").alias("listing_id"))


def crop_coordinates(raw: DataFrame) -> DataFrame:
    """Typed coordinates: bad or absent numbers get their default, empty crops are dropped."""
    def number(name: str, default: int) -> Column:
        if name not in raw.columns:
            return F.lit(default).alias(name)
        return text.to_int(F.col(name).cast("string"), default).alias(name)

    typed = raw.select(
        "listing_id", *[number(c, 0) for c in ("x", "y", "w", "h")], number("image", 1),
        *[number(c, 0) for c in ("x_back", "y_back", "w_back", "h_back", "image_back")],
        *[c for c in raw.columns if c in ("tilt", "tilt_back")])
    return typed.withColumn("has_back", artwork.has_back(F.col("w_back"), F.col("h_back"))).filter(
        (F.col("w") > 0) & (F.col("h") > 0))


def extraction_work(coords: DataFrame, images: DataFrame, outputs: DataFrame,
                    skip_done: bool = True, back_only: bool = False,
                    process_back: bool = True) -> DataFrame:
    """Crops to extract, with the image each side is taken from.

    coords as ``crop_coordinates`` gives them; images: listing_id, images array; outputs:
    listing_id, side (front / back) of files already there.
    """
    joined = coords.join(images, "listing_id", "left")
    front = artwork.image_at(F.col("images"), F.col("image"))
    wants_back = F.col("has_back") & F.lit(process_back)
    rows = joined.withColumn("image_url", front).withColumn(
        "image_col", artwork.image_column_at(F.col("images"), F.col("image"))).withColumn(
        "back_image_url", F.when(wants_back, artwork.image_at(
            F.col("images"), F.col("image_back")))).withColumn(
        "back_image_col", F.when(wants_back, artwork.image_column_at(
            F.col("images"), F.col("image_back"))))
    rows = rows.filter(F.col("image_url").isNotNull()).drop("images")
    fronts = outputs.filter(F.col("side") == "front").select("listing_id")
    backs = outputs.filter(F.col("side") == "back").select("listing_id")
    if back_only:
        return members(rows.filter("has_back"), backs, ["listing_id"], keep=False, counted_on=coords)
    if skip_done:
        rows = members(rows, fronts, ["listing_id"], keep=False, counted_on=coords)
        if process_back:
            done = backs.filter(F.col("listing_id").isNotNull()).distinct()
            rows = lookup(rows, done.withColumn("_back_done", F.lit(True)), ["listing_id"],
                          counted_on=coords)
            rows = rows.withColumn("back_skip_done", F.col("has_back") & F.col(
                "_back_done").isNotNull()).drop("_back_done")
    return rows


def large_images(images: DataFrame) -> DataFrame:
    """Images big enough on both sides (listing_id, images array of url / width / height).

    ``image_index`` is the 1-based place in the listing.
    """
    rows = images.select("listing_id", F.posexplode("images").alias("_place", "image"))
    return rows.filter(
        (F.col("image.url") != "") & (F.col("image.width") >= values.MIN_IMAGE_SIDE)
        & (F.col("image.height") >= values.MIN_IMAGE_SIDE)).select(
        "listing_id", (F.col("_place") + 1).cast("bigint").alias("image_index"),
        F.col("image.url").alias("url"))


def compose_mode(mode: str, has_back: Column, sides_ready: bool) -> Column:
    """single or sides for a listing; sides needs a back, a sides mock-up and a sides config."""
    if mode not in ("auto", "sides", "single"):
        raise ValueError(f"unknown mode: {mode}")
    if mode == "single" or not sides_ready:
        return F.lit("single")
    return F.when(has_back, "sides").otherwise("single")


def compose_plan(arts: DataFrame, mode: str, single_mockups: Sequence[str], single_config: str,
                 sides_mockups: Sequence[str], sides_config: str | None, outputs: DataFrame,
                 extension: str = "jpg", skip_done: bool = True) -> DataFrame:
    """One row per listing and mock-up photo of its mode, with the output name and the status.

    arts: listing_id, has_back. Mock-up photos are a short hand-made list (checked), unrolled
    per listing inside the scan stage.
    """
    if max(len(single_mockups), len(sides_mockups)) > MAX_MOCKUPS:
        raise ValueError(f"more than {MAX_MOCKUPS} mock-ups in one list")
    none = F.array().cast("array<string>")
    singles = F.array(*[F.lit(m) for m in single_mockups]) if single_mockups else none
    sides = F.array(*[F.lit(m) for m in sides_mockups]) if sides_mockups else none
    moded = arts.withColumn("mode", compose_mode(
        mode, F.col("has_back"), bool(sides_mockups and sides_config)))
    two_sided = F.col("mode") == "sides"
    rows = moded.withColumn("mockup", F.explode(F.when(two_sided, sides).otherwise(singles)))
    rows = rows.withColumn("config", F.when(two_sided, F.lit(sides_config)).otherwise(
        F.lit(single_config))).withColumn("output", F.concat(
            urls.stem(F.col("mockup")), F.lit("_"), F.col("listing_id"),
            F.when(two_sided, "_sides").otherwise(""), F.lit(f".{extension.lower()}")))
    if not skip_done:
        return rows.withColumn("status", F.lit("todo"))
    done = outputs.select("listing_id", "output").distinct().withColumn("_done", F.lit(True))
    return rows.join(done, ["listing_id", "output"], "left").withColumn(
        "status", F.when(F.col("_done"), "skipped").otherwise("todo")).drop("_done")


def pose_plan(arts: DataFrame, mockups: Sequence[str], configs: Mapping[str, Mapping],
              fallback: bool = True) -> DataFrame:
    """Every art on every mock-up photo, each photo under the config its file name stands for.

    Two-sided plans pass ``fallback=False``: photos without a config are left out.
    """
    if len(mockups) > MAX_MOCKUPS:
        raise ValueError(f"more than {MAX_MOCKUPS} mock-ups in one list")
    rows = arts.withColumn("mockup", F.explode(F.array(*[F.lit(m) for m in mockups])))
    keyed = rows.withColumn("config", artwork.config_key(
        urls.stem(F.col("mockup")), list(configs), fallback))
    return keyed.filter(F.col("config").isNotNull())


def outputs_by_listing(files: DataFrame, source: DataFrame, shop: str, most: int) -> DataFrame:
    """The first ``most`` mock-up files grouped under their listing, source order first.

    files: path. source: listing_id, title, tags, pos; the last row of an id gives title and
    tags, the first its place. ``place`` is null for ids the source does not know.
    """
    stem = urls.stem(F.col("path"))
    singles = files.filter(
        stem.contains("_single") & F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(
            ".png", ".jpg", ".jpeg")).select(
        urls.leading_id(stem).alias("listing_id"), "path").filter(
        F.col("listing_id").isNotNull())
    grouped = first_items(singles, "listing_id", "path", [F.col("path")], most)
    meta = source.groupBy("listing_id").agg(
        F.min("pos").alias("place"), F.max_by("title", "pos").alias("title"),
        F.max_by("tags", "pos").alias("tags"))
    return grouped.join(meta, "listing_id", "left").select(
        F.lit(shop).alias("shop_name"), "listing_id", "title", "tags", "items",
        "place").orderBy(F.col("place").asc_nulls_last(), "listing_id")


def next_pass(last_pass: DataFrame, listings: DataFrame) -> DataFrame:
    """Listings the last pass found no image for: the input of the next pass."""
    lacking = last_pass.filter((F.col("listing_id") != "") & (
        F.coalesce(F.col("image_1"), F.lit("")) == "")).select("listing_id")
    return members(listings, lacking, ["listing_id"])


def merge_passes(passes: DataFrame) -> DataFrame:
    """One row per listing: the last pass that found an image, else the first pass."""
    return dedup.later_pass_wins(passes, "listing_id", "pass_no", F.col("image_1") != "")
