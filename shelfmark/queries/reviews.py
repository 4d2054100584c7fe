"""Review histories: orders stand for reviews of the customer's item."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import query, spread, table
from ..functions import dates, names, text, urls
from ..operators import dedup
from ..plans import inactive, runs
from ..sources import page_blocks

CUTOFF = "2001-03-01"


def _review_export(spark, sf_dir):
    """Orders in the shape of a review export; every 50th customer has no item URL."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_custkey").cast("string")
    return orders.select(
        F.when(F.col("o_custkey") % 50 != 0,
               F.concat(F.lit("https://shop.example/listing/"), key, F.lit("/item"))).alias("url"),
        F.concat(F.lit("Buyer "), key, F.lit(" on "),
                 F.date_format("o_orderdate", "MMM d, yyyy")).alias("data"),
        F.concat(F.lit("Item "), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("img"), F.col("o_orderkey").cast("string")).alias("image"),
        "o_orderkey")


_EXPORT_SQL = """
export AS (
  SELECT CASE WHEN o_custkey % 50 <> 0
              THEN 'https://shop.example/listing/' || o_custkey || '/item' END AS url,
         CASE WHEN o_custkey % 50 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS listing_id,
         'Item ' || o_orderkey AS title, 'img' || o_orderkey AS image,
         CAST(o_orderdate AS DATE) AS day, o_orderkey
  FROM orders),
latest AS (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY day DESC, o_orderkey) AS rn,
         CASE WHEN url IS NOT NULL THEN count(*) OVER (PARTITION BY url) END AS review_count
  FROM export)
"""


@query("inactive_items", f"""WITH {_EXPORT_SQL}
SELECT 'Some Shop' AS shop_name, listing_id, title, '' AS tags, image AS image_1,
       url AS etsy_url, review_count, strftime(day, '%Y-%m-%d') AS last_review_date
FROM latest WHERE rn = 1 AND day < DATE '{CUTOFF}'""")
def inactive_items(spark, sf_dir):
    latest = inactive.latest_reviews(_review_export(spark, sf_dir), ["o_orderkey"])
    return inactive.hidden_table(latest, CUTOFF, "Some Shop")


@query("activity_counts", f"""WITH {_EXPORT_SQL}
SELECT count(*) AS total, count(*) FILTER (day < DATE '{CUTOFF}') AS hidden,
       count(*) - count(*) FILTER (day < DATE '{CUTOFF}') AS active
FROM latest WHERE rn = 1""")
def activity_counts(spark, sf_dir):
    latest = inactive.latest_reviews(_review_export(spark, sf_dir), ["o_orderkey"])
    return inactive.activity_counts(latest, F.col("review_day"), CUTOFF)


@query("latest_per_key_nulls_last", """
SELECT o_custkey, o_orderkey, day, review_count FROM (
  SELECT o_custkey, o_orderkey, day,
         row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC NULLS LAST, o_orderkey) AS rn,
         count(*) OVER (PARTITION BY o_custkey) AS review_count
  FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day
        FROM orders)) WHERE rn = 1 ORDER BY day DESC NULLS LAST, o_orderkey""")
def latest_per_key_nulls_last(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(
        F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("day"))
    best = dedup.latest_with_count(rows, "o_custkey", F.col("day"), ["o_orderkey"])
    return best.orderBy(F.col("day").desc_nulls_last(), "o_orderkey")


@query("review_blocks", """
WITH b AS (
  SELECT o_orderkey AS page_id, 0 AS place, 'Cust ' || o_custkey AS name,
         CAST(NULL AS VARCHAR) AS review_date, CAST(o_orderkey % 5 + 1 AS VARCHAR) AS rating,
         'https://shop.example/listing/' || o_orderkey || '/x' AS item_url,
         'Item ' || o_orderkey AS item_name FROM orders
  UNION ALL
  SELECT o_orderkey, 1, 'Buyer ' || o_custkey, strftime(o_orderdate, '%d-%m-%Y'), '4', NULL, NULL
  FROM orders)
SELECT * FROM b""")
def review_blocks(spark, sf_dir):
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    html = F.concat(
        F.lit('<ul><li data-region="review"><p class="wide shop2-review-attribution">'
              '<a href="/people/x">Cust '), cust, F.lit("</a> on "),
        F.date_format("o_orderdate", "MMM d, yyyy"),
        F.lit('</p><input name="rating" value="'), (F.col("o_orderkey") % 5 + 1).cast("string"),
        F.lit('"><div data-region="listing"><a href="/listing/'), key,
        F.lit('/x?ref=1#top" aria-label="Item '), key, F.lit('">pic</a></div></li>'
              '<li data-region="review"><p class="shop2-review-attribution">Buyer '), cust,
        F.lit(" on "), F.date_format("o_orderdate", "MMMM d, yyyy"),
        F.lit('</p><span class="stars-svg"><span class="screen-reader-only"> 4 out of 5 stars'
              '</span></span></li><li data-region="review"><p>empty</p></li></ul>'))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pages = spread(orders).select(F.col("o_orderkey").alias("page_id"), html.alias("html"))
    found = page_blocks.reviews(pages)
    return found.select(
        "page_id", "place", "name", dates.day_text(F.col("date_text")).alias("review_date"),
        text.leading_digit(F.col("rating_text")).alias("rating"),
        urls.clean(F.col("item_href"), "https://shop.example").alias("item_url"), "item_name")


@query("prefix_until_repeat", """
WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 9 <> 0 THEN event_type END AS item
           FROM events),
s AS (SELECT user_id, min(event_id) AS start_id,
             arg_min(item, event_id) FILTER (item IS NOT NULL) AS first_item
      FROM e GROUP BY user_id),
t AS (SELECT e.user_id, min(event_id) AS stop_id FROM e JOIN s USING (user_id)
      WHERE item = first_item AND event_id > start_id GROUP BY e.user_id)
SELECT e.user_id, e.event_id, e.item FROM e LEFT JOIN t USING (user_id)
WHERE stop_id IS NULL OR event_id < stop_id""")
def prefix_until_repeat(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(
        F.col("event_id") % 9 != 0, F.col("event_type")).alias("item"))
    return dedup.prefix_until_repeat(rows, "user_id", "event_id", "item")


@query("first_wins", """
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1""")
def first_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return dedup.first_wins(rows, ["user_id", "event_type"],
                            [F.col("ts"), F.col("event_id")]).drop("ts")


@query("last_wins", """
SELECT event_id, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def last_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return dedup.last_wins(rows, ["user_id"], "event_id")


@query("best_wins", """
SELECT source, lang, doc_id, words FROM (
  SELECT source, lang, doc_id, len(string_split(text, ' ')) AS words,
         row_number() OVER (PARTITION BY source, lang
                            ORDER BY len(string_split(text, ' ')) DESC, doc_id) AS rn
  FROM documents) WHERE rn = 1""")
def best_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "source", "lang", "doc_id", F.split("text", " ").alias("words"))
    best = dedup.longest_wins(rows, ["source", "lang"], "words", [F.col("doc_id")])
    return best.withColumn("words", F.size("words").cast("bigint"))


@query("first_per_id", """
SELECT listing_id, l_orderkey, l_linenumber FROM (
  SELECT CASE WHEN l_partkey % 10 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS listing_id,
         l_orderkey, l_linenumber,
         row_number() OVER (PARTITION BY l_partkey
                            ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS rn
  FROM lineitem) WHERE rn = 1 AND listing_id <> ''""")
def first_per_id(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_partkey") % 10 == 0, "").otherwise(
            F.col("l_partkey").cast("string")).alias("listing_id"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")]
    return dedup.first_per_id(rows, "listing_id", order).drop("l_suppkey", "l_extendedprice")


@query("later_pass_wins", """
WITH p AS (SELECT user_id, event_id, event_type = 'purchase' AS found FROM events),
r AS (SELECT *, row_number() OVER (
        PARTITION BY user_id
        ORDER BY found DESC, CASE WHEN found THEN -event_id ELSE event_id END) AS rn FROM p)
SELECT user_id, event_id, found FROM r WHERE rn = 1""")
def later_pass_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id"), "event_id", (F.col("event_type") == "purchase").alias("found"))
    keyed = rows.withColumn("key", F.col("user_id").cast("string"))
    return dedup.later_pass_wins(keyed, "key", "event_id", F.col("found")).drop("key")


@query("date_parsers", r"""
SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS crawled,
       strftime(o_orderdate, '%d-%m-%Y') AS crawled_long, 'n/a ' || o_custkey AS crawled_bad,
       CAST(o_orderdate AS DATE) AS deadline, CAST(o_orderkey % 5 + 1 AS VARCHAR) AS rating,
       CAST(o_custkey AS VARCHAR) AS age, CASE o_orderkey % 3 WHEN 0 THEN '.png' ELSE '.jpg' END
         AS ext, o_orderkey % 2 = 0 AS local_file,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey AS VARCHAR) END AS art_id,
       CASE WHEN o_custkey % 2 = 0 THEN o_orderkey || ' — ' || repeat('ab', 30)
            ELSE repeat('ab', 40) END AS card_key
FROM orders""")
def date_parsers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day, cust = F.col("o_orderdate"), F.col("o_custkey").cast("string")
    key = F.col("o_orderkey")
    link = F.concat(F.lit("https://img.example/a/"), cust,
                    F.when(key % 3 == 0, ".png?v=1").when(key % 3 == 1, "").otherwise(".jpg"))
    long_title = F.repeat(F.lit("ab"), 55)
    return orders.select(
        "o_orderkey",
        dates.day_text(F.concat(F.lit(" on "), F.date_format(day, "MMM d, yyyy"))).alias("crawled"),
        dates.day_text(F.date_format(day, "MMMM d, yyyy")).alias("crawled_long"),
        dates.day_text(F.concat(F.lit("On n/a "), cust)).alias("crawled_bad"),
        dates.deadline_day(dates.deadline_text(F.concat(
            F.lit("until "), F.date_format(day, "d/M/yyyy"), F.lit(" noon")))).alias("deadline"),
        text.leading_digit(F.concat((key % 5 + 1).cast("string"),
                                    F.lit(" out of 5 stars"))).alias("rating"),
        text.first_integer(F.concat(cust, F.lit(" Mo."))).alias("age"),
        urls.extension(link).alias("ext"),
        urls.is_local(F.when(key % 2 == 0, F.lit("C:/x.png")).otherwise(link)).alias("local_file"),
        urls.id_before(urls.stem(F.concat(F.lit("out/"), cust, F.when(
            key % 4 == 0, "_art.png").otherwise("_x.png"))), "_art").alias("art_id"),
        names.card_key(F.when(F.col("o_custkey") % 2 == 0, key.cast("string")).otherwise(F.lit("")),
                       long_title).alias("card_key"))




@query("age_months", """
SELECT o_orderkey, round(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01')
                         / 30.44, 1) AS created_age FROM orders""")
def age_months(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.age_in_months(
        F.to_date("o_orderdate"), F.lit("2002-01-01").cast("date")).alias("created_age"))


@query("nameless_reviews_dropped", """
SELECT 'Some Shop' AS shop_name, '' AS tags, o_orderkey,
       CASE WHEN o_orderkey % 3 <> 0 THEN 'Buyer ' || o_custkey END AS name,
       CASE WHEN o_orderkey % 5 <> 0 THEN '/listing/' || o_orderkey END AS item_url
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 5 <> 0""")
def nameless_reviews_dropped(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.lit("Some Shop").alias("shop_name"), F.lit("").alias("tags"), "o_orderkey",
        F.when(key % 3 != 0, F.concat(F.lit("Buyer "), F.col("o_custkey").cast("string")))
        .alias("name"),
        F.when(key % 5 != 0, F.concat(F.lit("/listing/"), key.cast("string"))).alias("item_url"))
    return rows.filter(F.coalesce("name", "item_url").isNotNull())


@query("inactive_to_board", f"""WITH {_EXPORT_SQL},
h AS (SELECT listing_id, title, o_orderkey,
             CASE WHEN CAST(listing_id AS BIGINT) % 3 = 0 THEN 2 ELSE 1 END AS n_images,
             row_number() OVER (ORDER BY listing_id) AS seq
      FROM latest WHERE rn = 1 AND day < DATE '{CUTOFF}' AND url IS NOT NULL),
a AS (SELECT *, CASE WHEN o_orderkey % 4 > 1 THEN 'create' WHEN o_orderkey % 4 = 0
                     THEN CASE WHEN n_images = 1 THEN 'skip' ELSE 'reattach' END
                     ELSE 'reattach' END AS action FROM h)
SELECT listing_id, title, n_images, action, CAST(10 + sum(CASE WHEN action = 'skip' THEN 0 ELSE 1 END)
  OVER (ORDER BY seq) - CASE WHEN action = 'skip' THEN 0 ELSE 1 END AS BIGINT) AS counter FROM a""")
def inactive_to_board(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    images = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(
        F.col("c_custkey").cast("string").alias("listing_id"),
        F.array(F.lit("a"), F.lit(""), F.lit("b")).alias("images"))
    cards = orders.filter("o_orderkey % 4 < 2").select(
        F.lit("Some Shop").alias("list_name"), F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("Item "), F.col("o_orderkey").cast("string")).alias("name"),
        F.lit("").alias("desc"), F.when(F.col("o_orderkey") % 4 == 0, 1).otherwise(0)
        .alias("attachment_count"), F.col("o_orderkey").alias("pos"))
    plan = runs.inactive_to_board(_review_export(spark, sf_dir), ["o_orderkey"], CUTOFF,
                                  "Some Shop", images, cards, 10)
    return plan.select("listing_id", "title", "n_images", "action", "counter")
