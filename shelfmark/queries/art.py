"""Artwork plans: extraction work, composition, produced files."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import query, table
from ..functions import artwork, urls
from ..plans import artwork as plans
from ..sources.sinks import image_files
from ..values import MAX_LISTING_IMAGES

# Sample placement configs in the shape of a placement file.
CONFIGS = {
    "pose_A": {"anchor": [0.5, 0.25], "scale": 0.5, "scale_by": "width", "shape_overrides": {
        "portrait": {"anchor": [0.5, 0.5], "scale": 0.25, "scale_by": "height"}}},
    "pose_B": {"anchor": [0.25, 0.5], "scale": 0.75, "scale_by": "height",
               "shape_overrides": {"landscape": {"scale": 0.125}}},
    "pose_AB": {"anchor": [0.5, 0.5], "scale": 0.25, "scale_by": "width"},
}
MOCKUPS = ["White-pose_AB1.jpg", "navy_b2.png", "x/unknown.webp"]


@query("longest_key_match", """
WITH s AS (SELECT p_partkey, lower(CASE p_partkey % 4
             WHEN 0 THEN replace(p_name, ' ', '_') || '_POSE_AB7'
             WHEN 1 THEN p_partkey || 'a' WHEN 2 THEN p_name || '-b2' ELSE p_name || 'xa' END) AS stem
           FROM part),
m AS (SELECT *, CASE WHEN contains(stem, 'pose_ab') THEN 'pose_AB'
             WHEN contains(stem, 'pose_a') THEN 'pose_A' WHEN contains(stem, 'pose_b') THEN 'pose_B'
             WHEN regexp_matches(stem, '(^|[^a-z])ab([^a-z]|$)') THEN 'pose_AB'
             WHEN regexp_matches(stem, '(^|[^a-z])a([^a-z]|$)') THEN 'pose_A'
             WHEN regexp_matches(stem, '(^|[^a-z])b([^a-z]|$)') THEN 'pose_B' END AS strict FROM s)
SELECT p_partkey, strict, coalesce(strict, 'pose_A') AS config FROM m""")
def longest_key_match(spark, sf_dir):
    key = F.col("p_partkey")
    stem = (F.when(key % 4 == 0, F.concat(F.replace("p_name", F.lit(" "), F.lit("_")),
                                          F.lit("_POSE_AB7")))
            .when(key % 4 == 1, F.concat(key.cast("string"), F.lit("a")))
            .when(key % 4 == 2, F.concat(F.col("p_name"), F.lit("-b2")))
            .otherwise(F.concat(F.col("p_name"), F.lit("xa"))))
    return table(spark, sf_dir, "part").select(
        "p_partkey", artwork.config_key(stem, list(CONFIGS), False).alias("strict"),
        artwork.config_key(stem, list(CONFIGS)).alias("config"))


@query("garment_tone", """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'light' WHEN 1 THEN 'dark' ELSE 'mid' END AS tone,
       CASE p_partkey % 3 WHEN 1 THEN 'screen' ELSE 'multiply' END AS blend FROM part""")
def garment_tone(spark, sf_dir):
    key = F.col("p_partkey")
    stem = F.concat(key.cast("string"), F.when(key % 3 == 0, "-Cream_navy").when(
        key % 3 == 1, "_wine").otherwise("_creamy"))
    tone = artwork.tone(stem)
    return table(spark, sf_dir, "part").select("p_partkey", tone.alias("tone"),
                                               artwork.blend_mode(tone).alias("blend"))


@query("chosen_blend", """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'overlay' WHEN p_partkey % 3 = 1 THEN 'screen'
       ELSE 'multiply' END AS blend FROM part""")
def chosen_blend(spark, sf_dir):
    key = F.col("p_partkey")
    stem = F.concat(key.cast("string"), F.when(key % 3 == 0, "-Cream_navy").when(
        key % 3 == 1, "_wine").otherwise("_creamy"))
    auto = F.when(key % 5 == 0, False).when(key % 5 == 1, True)     # else not said
    return table(spark, sf_dir, "part").select("p_partkey", artwork.chosen_blend(
        auto, F.lit("overlay"), artwork.tone(stem)).alias("blend"))


@query("art_geometry", """
WITH a AS (SELECT p_partkey, p_size * 40 AS w, (p_partkey % 50 + 1) * 30 AS h,
                  CASE p_partkey % 3 WHEN 0 THEN 'pose_A' WHEN 1 THEN 'pose_B' ELSE 'pose_AB' END AS k
           FROM part),
s AS (SELECT *, CASE WHEN w / h < 0.77 THEN 'portrait' WHEN w / h > 1.30 THEN 'landscape'
                ELSE 'square' END AS shape FROM a),
c AS (SELECT *, CASE WHEN k = 'pose_A' AND shape = 'portrait' THEN 0.25 WHEN k = 'pose_A' THEN 0.5
                WHEN k = 'pose_B' AND shape = 'landscape' THEN 0.125 WHEN k = 'pose_B' THEN 0.75
                ELSE 0.25 END AS scale,
             k = 'pose_B' OR k = 'pose_A' AND shape = 'portrait' AS tall,
             CASE k WHEN 'pose_B' THEN 0.25 ELSE 0.5 END AS ax,
             CASE WHEN k = 'pose_A' AND shape <> 'portrait' THEN 0.25 ELSE 0.5 END AS ay FROM s),
n AS (SELECT *, CASE WHEN tall THEN CAST(trunc(w * trunc(1500 * scale) / h) AS BIGINT)
                ELSE CAST(trunc(1000 * scale) AS BIGINT) END AS new_w,
             CASE WHEN tall THEN CAST(trunc(1500 * scale) AS BIGINT)
                ELSE CAST(trunc(h * trunc(1000 * scale) / w) AS BIGINT) END AS new_h FROM c)
SELECT p_partkey, shape, new_w, new_h, CAST(trunc(ax * 1000) AS BIGINT) - new_w // 2 AS left_x,
       CAST(trunc(ay * 1500) AS BIGINT) - new_h // 2 AS top_y FROM n""")
def art_geometry(spark, sf_dir):
    key, w = F.col("p_partkey"), F.col("p_size") * 40
    h = (key % 50 + 1) * 30
    shape = artwork.shape(w, h)
    config = F.when(key % 3 == 0, "pose_A").when(key % 3 == 1, "pose_B").otherwise("pose_AB")
    rows = table(spark, sf_dir, "part").select("p_partkey", w.alias("w"), h.alias("h"),
                                               shape.alias("shape"), config.alias("config"))

    def value(field):
        return artwork.config_value(F.col("config"), F.col("shape"), CONFIGS, field)

    anchor = value("anchor")
    spot = artwork.placement(F.lit(1000), F.lit(1500), F.col("w"), F.col("h"), value("scale"),
                             value("scale_by"), F.get(anchor, F.lit(0)), F.get(anchor, F.lit(1)))
    return rows.withColumn("spot", spot).select(
        "p_partkey", "shape", *[F.col(f"spot.{a}").cast("bigint").alias(b) for a, b in (
            ("new_w", "new_w"), ("new_h", "new_h"), ("left", "left_x"), ("top", "top_y"))])


@query("crop_boxes", """
WITH c AS (SELECT p_partkey, p_partkey % 90 - 10 AS x, p_size - 5 AS y FROM part)
SELECT p_partkey, CASE WHEN x < 60 AND y < 40 THEN greatest(0, x) END AS left_x,
       CASE WHEN x < 60 AND y < 40 THEN least(40, y + 25) END AS bottom_y FROM c""")
def crop_boxes(spark, sf_dir):
    x, y = F.col("p_partkey") % 90 - 10, F.col("p_size") - 5
    box = artwork.crop_box(x, y, F.lit(30), F.lit(25), F.lit(60), F.lit(40))
    return table(spark, sf_dir, "part").withColumn("box", box).select(
        "p_partkey", F.col("box.left").cast("bigint").alias("left_x"),
        F.col("box.bottom").cast("bigint").alias("bottom_y"))


@query("pose_plan", """
SELECT p_partkey AS listing_id, m AS mockup, CASE m WHEN 'White-pose_AB1.jpg' THEN 'pose_AB'
  WHEN 'navy_b2.png' THEN 'pose_B' ELSE 'pose_A' END AS config
FROM part, (VALUES ('White-pose_AB1.jpg'), ('navy_b2.png'), ('x/unknown.webp')) v(m)""")
def pose_plan(spark, sf_dir):
    arts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("listing_id"))
    return plans.pose_plan(arts, MOCKUPS, CONFIGS)


@query("compose_plan", """
WITH a AS (SELECT p_partkey, p_size % 3 = 0 AS has_back FROM part),
e AS (SELECT p_partkey, has_back, m, s FROM a,
        (VALUES ('m1', false), ('m2', false), ('two', true)) v(m, s) WHERE s = has_back)
SELECT CAST(p_partkey AS VARCHAR) AS listing_id, CASE WHEN s THEN 'sides' ELSE 'single' END AS mode,
       m || '.png' AS mockup, CASE WHEN s THEN 'sides_A' ELSE 'pose_A' END AS config,
       m || '_' || p_partkey || CASE WHEN s THEN '_sides.jpg' ELSE '.jpg' END AS output,
       CASE WHEN m = 'm1' AND p_partkey % 2 = 0 THEN 'skipped' ELSE 'todo' END AS status FROM e""")
def compose_plan(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    arts = parts.select(key.alias("listing_id"), (F.col("p_size") % 3 == 0).alias("has_back"))
    outputs = parts.filter("p_partkey % 2 = 0").select(
        key.alias("listing_id"), F.concat(F.lit("m1_"), key, F.lit(".jpg")).alias("output"))
    return plans.compose_plan(arts, "auto", ["m1.png", "m2.png"], "pose_A", ["two.png"], "sides_A",
                              outputs, "JPG").drop("has_back")


_WORK_SQL = """
c AS (SELECT CAST(p_partkey AS VARCHAR) AS listing_id, p_partkey, p_size AS w,
             p_size % 5 AS image, p_size % 3 AS w_back, p_partkey % 4 AS image_back FROM part
      WHERE p_size % 7 > 0),
r AS (SELECT c.*, w_back > 0 AS has_back,
             CASE image WHEN 2 THEN 'b' || s_suppkey ELSE 'a' || s_suppkey END AS image_url,
             CASE image WHEN 2 THEN 'image_2' ELSE 'image_1' END AS image_col,
             CASE WHEN w_back > 0 THEN CASE image_back WHEN 2 THEN 'b' || s_suppkey
                  ELSE 'a' || s_suppkey END END AS back_image_url
      FROM c JOIN supplier ON s_suppkey = p_partkey % 150)
"""


def _work_inputs(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    raw = parts.select(
        key.alias("listing_id"), F.lit("1").alias("x"), F.lit("bad").alias("y"),
        F.when(F.col("p_size") % 7 > 0, F.col("p_size").cast("string")).alias("w"),
        F.lit("9").alias("h"), (F.col("p_size") % 5).cast("string").alias("image"),
        (F.col("p_size") % 3).cast("string").alias("w_back"), F.lit("1.9").alias("h_back"),
        (F.col("p_partkey") % 4).cast("string").alias("image_back"))
    supplier = F.col("s_suppkey").cast("string")
    urls_of = F.array(F.concat(F.lit("a"), supplier), F.concat(F.lit("b"), supplier), F.lit(""))
    images = parts.join(table(spark, sf_dir, "supplier"),
                        F.col("p_partkey") % 150 == F.col("s_suppkey")).select(
        key.alias("listing_id"), urls_of.alias("images"))
    outputs = parts.filter("p_partkey % 6 < 2").select(
        key.alias("listing_id"), F.when(F.col("p_partkey") % 6 == 0, "front").otherwise("back")
        .alias("side"))
    return plans.crop_coordinates(raw), images, outputs


@query("work_list", f"""WITH {_WORK_SQL}
SELECT listing_id, w, image_url, image_col, back_image_url,
       has_back AND p_partkey % 6 = 1 AS back_skip_done FROM r WHERE p_partkey % 6 <> 0""")
def work_list(spark, sf_dir):
    return plans.extraction_work(*_work_inputs(spark, sf_dir)).select(
        "listing_id", "w", "image_url", "image_col", "back_image_url", "back_skip_done")


@query("work_list_back_only", f"""WITH {_WORK_SQL}
SELECT listing_id, back_image_url FROM r WHERE has_back AND p_partkey % 6 <> 1""")
def work_list_back_only(spark, sf_dir):
    return plans.extraction_work(*_work_inputs(spark, sf_dir), back_only=True).select(
        "listing_id", "back_image_url")


@query("outputs_to_listings", """
WITH f AS (SELECT l_partkey, l_orderkey, l_linenumber, 'out/' || l_partkey || '_pose_' || l_orderkey
             || '_' || l_linenumber || '_single.png' AS path FROM lineitem WHERE l_linenumber < 5),
g AS (SELECT l_partkey, string_agg(path, ',' ORDER BY path) AS images FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY path) AS rn
        FROM (SELECT DISTINCT l_partkey, path FROM f)) WHERE rn <= 20 GROUP BY l_partkey)
SELECT 'Mock-ups' AS shop_name, CAST(l_partkey AS VARCHAR) AS listing_id, p_name AS title,
       p_type AS tags, images, 5000 - p_partkey AS place
FROM g LEFT JOIN (SELECT * FROM part WHERE p_partkey % 3 > 0) ON p_partkey = l_partkey""")
def outputs_to_listings(spark, sf_dir):
    files = table(spark, sf_dir, "lineitem").select(F.concat(
        F.lit("out/"), F.col("l_partkey").cast("string"), F.lit("_pose_"),
        F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"),
        F.when(F.col("l_linenumber") < 5, "_single.png").otherwise("_sides.png")).alias("path"))
    source = table(spark, sf_dir, "part").filter("p_partkey % 3 > 0").select(
        F.col("p_partkey").cast("string").alias("listing_id"), F.col("p_name").alias("title"),
        F.col("p_type").alias("tags"), (5000 - F.col("p_partkey")).alias("pos"))
    found = plans.outputs_by_listing(files.distinct(), source, "Mock-ups", MAX_LISTING_IMAGES)
    return found.select("shop_name", "listing_id", "title", "tags",
                        F.array_join("items", ",").alias("images"), "place")


@query("refill_next_pass", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def refill_next_pass(spark, sf_dir):
    last = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("listing_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("image_1"))
    listings = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("listing_id"), "c_custkey", "c_name")
    return plans.next_pass(last, listings).drop("listing_id")


@query("image_file_names", """
SELECT 'Shop ' || c_nationkey AS shop_name, c_custkey AS listing_id, 1 AS position,
       'https://i.example/' || c_custkey || '.PNG?x=1' AS url, 'image_1.PNG' AS file_name,
       'image/png' AS mime FROM customer""")
def image_file_names(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Shop "), F.col("c_nationkey").cast("string")).alias("shop_name"),
        F.col("c_custkey").alias("listing_id"),
        F.concat(F.lit("https://i.example/"), key, F.lit(".PNG?x=1")).alias("link"))
    return image_files(rows, "shop_name", "listing_id", F.lit(1), F.col("link")).withColumn(
        "mime", urls.mime(F.col("file_name")))


@query("arts_of_ids", """
SELECT 'art/' || l_orderkey || '_' || l_suppkey || '_art.png' AS path,
       CAST(l_orderkey AS VARCHAR) AS listing_id
FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def arts_of_ids(spark, sf_dir):
    paths = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct().select(
        F.concat(F.lit("art/"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_suppkey").cast("string"), F.lit("_art.png")).alias("path"))
    ids = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(
        F.col("o_orderkey").cast("string").alias("listing_id"))
    return plans.arts_of_ids(paths, ids)
