"""Joins: resume, id lists, fills, merges, matches, pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import query, table
from ..functions import artwork, urls
from ..operators import dedup, enrich, pairing


@query("resume_anti", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def resume_anti(spark, sf_dir):
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("c_custkey"))
    return enrich.unfinished(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), done,
                             "c_custkey")


@query("id_semi", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def id_semi(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'").select(
        F.col("c_custkey").alias("o_custkey"))
    return enrich.chosen(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ids,
                         "o_custkey")


@query("not_found", """
SELECT DISTINCT c_custkey * 3 AS o_custkey FROM customer
WHERE c_custkey * 3 NOT IN (SELECT o_custkey FROM orders)""")
def not_found(spark, sf_dir):
    asked = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 3).alias("o_custkey"))
    return enrich.not_found(asked, table(spark, sf_dir, "orders"), "o_custkey")


@query("ids_found_anywhere", """
SELECT c_custkey AS id FROM customer UNION SELECT s_suppkey * 100 FROM supplier""")
def ids_found_anywhere(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return customers.union(table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey") * 100)).distinct()


@query("ids_not_in_other", """
SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0""")
def ids_not_in_other(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return customers.subtract(table(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0").select(
        "o_custkey"))


@query("row_merge_outer", """
SELECT coalesce(c.k, s.k) AS row_index, coalesce(s.name, c.name) AS name,
       coalesce(s.balance, c.balance) AS balance, segment, nation
FROM (SELECT c_custkey AS k, nullif(c_name, 'Customer#000000003') AS name,
             CASE WHEN c_custkey % 4 > 0 THEN c_acctbal END AS balance,
             nullif(c_mktsegment, 'BUILDING') AS segment FROM customer WHERE c_custkey % 2 = 0) c
FULL JOIN (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS name,
                  CASE WHEN s_suppkey % 3 > 0 THEN s_acctbal END AS balance,
                  CASE WHEN s_suppkey % 5 > 0 THEN s_nationkey END AS nation FROM supplier) s
  ON c.k = s.k
WHERE coalesce(s.name, c.name) IS NOT NULL OR segment IS NOT NULL OR nation IS NOT NULL""")
def row_merge_outer(spark, sf_dir):
    left = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("row_index"),
        F.nullif("c_name", F.lit("Customer#000000003")).alias("name"),
        F.when(F.col("c_custkey") % 4 > 0, F.col("c_acctbal")).alias("balance"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    key = F.col("s_suppkey")
    right = table(spark, sf_dir, "supplier").select(
        key.alias("row_index"), F.when(key % 3 > 0, F.col("s_name")).alias("name"),
        F.when(key % 3 > 0, F.col("s_acctbal")).alias("balance"),
        F.when(key % 5 > 0, F.col("s_nationkey")).alias("nation"))
    merged = enrich.merge_rows(left, right, "row_index")
    return enrich.drop_hollow(merged, ["row_index", "balance"])


_LAST_SQL = """
last AS (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS tags FROM orders
         WHERE o_orderstatus <> 'F' GROUP BY o_custkey)"""


def _last_priority(spark, sf_dir, key, column):
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'").select(
        F.col("o_custkey").alias(key), F.col("o_orderpriority").alias(column), "o_orderkey")
    return dedup.last_wins(orders, [key], "o_orderkey").drop("o_orderkey")


@query("fill_missing", f"""WITH {_LAST_SQL}
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN coalesce(last.tags, '') ELSE c_mktsegment END
  AS tags FROM customer LEFT JOIN last ON o_custkey = c_custkey""")
def fill_missing(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(
        F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("tags"))
    return enrich.fill_missing(rows, _last_priority(spark, sf_dir, "c_custkey", "tags"),
                               "c_custkey", "tags")


@query("fill_when_gate_holds", f"""WITH {_LAST_SQL}
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_acctbal > 0 THEN coalesce(last.tags, '')
  WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS tags
FROM customer LEFT JOIN last ON o_custkey = c_custkey""")
def fill_when_gate_holds(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.when(
        F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("tags"))
    return enrich.fill_missing(rows, _last_priority(spark, sf_dir, "c_custkey", "tags"),
                               "c_custkey", "tags", F.col("c_acctbal") > 0).drop("c_acctbal")


_FIRST_SQL = """
t AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END
        AS image, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 AS is_first
      FROM orders),
news AS (SELECT c_custkey * 2 AS id, c_mktsegment AS image FROM customer),
j AS (SELECT t.*, news.image AS new FROM t LEFT JOIN news ON id = o_custkey AND is_first)
"""


def _targets(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(
        F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("image"))
    news = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("o_custkey"),
                                                   F.col("c_mktsegment").alias("image"))
    return rows, news


@query("overwrite_first", f"""WITH {_FIRST_SQL}
SELECT o_orderkey, o_custkey, coalesce(new, image) AS image FROM j""")
def overwrite_first(spark, sf_dir):
    rows, news = _targets(spark, sf_dir)
    return enrich.overwrite(rows, news, "o_custkey", "image", "o_orderkey")


@query("fill_first_match", f"""WITH {_FIRST_SQL}
SELECT o_orderkey, o_custkey, CASE WHEN image = '' THEN coalesce(new, image) ELSE image END AS image,
       CASE WHEN new IS NULL THEN 'untouched' WHEN image = '' THEN 'updated' ELSE 'skipped' END
         AS state FROM j""")
def fill_first_match(spark, sf_dir):
    rows, news = _targets(spark, sf_dir)
    return enrich.fill_first_match(rows, news, "o_custkey", "image", "o_orderkey",
                                   F.col("image") == "")


@query("fill_counts", f"""WITH {_FIRST_SQL}
SELECT count(*) FILTER (new IS NOT NULL AND image = '') AS updated,
       count(*) FILTER (new IS NOT NULL AND image <> '') AS skipped,
       (SELECT count(DISTINCT id) FROM news WHERE id NOT IN (SELECT o_custkey FROM orders))
         AS notfound FROM j""")
def fill_counts(spark, sf_dir):
    rows, news = _targets(spark, sf_dir)
    filled = enrich.fill_first_match(rows, news, "o_custkey", "image", "o_orderkey",
                                     F.col("image") == "")
    return enrich.update_counts(filled, news, "o_custkey")


@query("keep_failed_rows", """
SELECT o_orderkey, o_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_name END AS company,
       CASE WHEN c_nationkey % 2 = 0 THEN c_acctbal END AS size
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def keep_failed_rows(spark, sf_dir):
    readable = table(spark, sf_dir, "customer").filter("c_nationkey % 2 = 0").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("company"),
        F.col("c_acctbal").alias("size"))
    return enrich.keep_failed(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
                              readable, "o_custkey")


@query("title_lookup", """
WITH names AS (SELECT DISTINCT p_name AS title FROM part),
cat AS (SELECT trim(p_name) AS title, arg_max(p_partkey, p_partkey) AS listing_id FROM part
        WHERE p_partkey % 30 = 0 GROUP BY 1)
SELECT title, listing_id, CASE WHEN listing_id % 60 = 0 THEN 'u' || listing_id
         ELSE 'https://shop.example/listing/' || listing_id END AS url
FROM names LEFT JOIN cat USING (title)""")
def title_lookup(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    catalogue = parts.filter("p_partkey % 30 = 0").select(
        F.concat(F.lit(" "), F.col("p_name")).alias("title"),
        F.col("p_partkey").alias("listing_id"),
        F.when(F.col("p_partkey") % 60 == 0, F.concat(F.lit("u"), key)).otherwise("").alias("known"))
    link = urls.listing_url(F.col("known"), F.col("listing_id").cast("string"),
                            "https://shop.example")
    return enrich.title_lookup(parts.select(F.col("p_name").alias("title")).distinct(), catalogue,
                               "title", "listing_id", link, "listing_id")


@query("priority_match", """
WITH wanted AS (SELECT c_custkey AS listing_id, c_mktsegment || c_nationkey AS title FROM customer),
ids AS (SELECT o_custkey AS listing_id, max('card' || o_orderkey) AS card FROM orders
        WHERE o_orderstatus = 'F' GROUP BY 1),
titles AS (SELECT c_mktsegment || c_nationkey AS title, max('known' || c_custkey) AS card
           FROM customer WHERE c_acctbal > 9000 GROUP BY 1)
SELECT w.listing_id, w.title, coalesce(ids.card, titles.card) AS card,
       CASE WHEN ids.card IS NOT NULL THEN 'known_id' WHEN titles.card IS NOT NULL
            THEN 'known_title' ELSE 'create' END AS action
FROM wanted w LEFT JOIN ids ON ids.listing_id = w.listing_id
LEFT JOIN titles ON titles.title = w.title""")
def priority_match(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    title = F.concat(F.col("c_mktsegment"), F.col("c_nationkey").cast("string"))
    wanted = customers.select(F.col("c_custkey").alias("listing_id"), title.alias("title"))
    by_id = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").groupBy(
        F.col("o_custkey").alias("listing_id")).agg(F.max(F.concat(
            F.lit("card"), F.col("o_orderkey").cast("string"))).alias("card"))
    by_title = customers.filter("c_acctbal > 9000").groupBy(title.alias("title")).agg(
        F.max(F.concat(F.lit("known"), F.col("c_custkey").cast("string"))).alias("card"))
    return enrich.match_by_priority(wanted, by_id, by_title, "listing_id", "title", "card")


@query("or_match", """
WITH cards AS (SELECT s_nationkey AS nation, s_suppkey AS pos, 'Order ' || s_suppkey AS name,
                      s_name AS alias FROM supplier),
wanted AS (SELECT c_custkey, c_nationkey AS nation, CASE WHEN c_custkey % 2 = 0
             THEN 'Order ' || c_custkey % 100
             ELSE 'Supplier#' || lpad(CAST(c_custkey % 100 AS VARCHAR), 9, '0') END AS title
           FROM customer)
SELECT c_custkey, w.nation, title, min(pos) AS card, count(pos) > 0 AS matched
FROM wanted w LEFT JOIN cards c ON c.nation = w.nation AND (c.name = title OR c.alias = title)
GROUP BY ALL""")
def or_match(spark, sf_dir):
    cards = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("pos"),
        F.col("s_suppkey").alias("card"), F.concat(F.lit("Order "), F.col("s_suppkey").cast(
            "string")).alias("name"), F.col("s_name").alias("alias"))
    digits = (F.col("c_custkey") % 100).cast("string")
    wanted = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nation"), F.when(
            F.col("c_custkey") % 2 == 0, F.concat(F.lit("Order "), digits)).otherwise(
            F.concat(F.lit("Supplier#"), F.lpad(digits, 9, "0"))).alias("title"))
    return enrich.match_any(wanted, cards, ["nation"], "title", [F.col("name"), F.col("alias")],
                            "pos", ["card"])


@query("pick_by_index", """
SELECT p_partkey, CASE p_size % 5 - 1 WHEN 2 THEN p_name WHEN 3 THEN p_brand
  ELSE p_name END AS url, CASE p_size % 5 - 1 WHEN 3 THEN 'image_3' ELSE 'image_1' END AS source
FROM part""")
def pick_by_index(spark, sf_dir):
    images = F.array(F.col("p_name"), F.lit(""), F.col("p_brand"))
    index = (F.col("p_size") % 5 - 1).cast("int")
    return table(spark, sf_dir, "part").select(
        "p_partkey", artwork.image_at(images, index).alias("url"),
        artwork.image_column_at(images, index).alias("source"))


@query("pair_with_fallback", """
WITH f AS (SELECT 'art_' || p_partkey || '_front' AS front, 'art_' || p_partkey AS k FROM part
           WHERE p_partkey % 2 = 0 OR p_partkey > 500),
b AS (SELECT 'art_' || s_suppkey * 30 || '_back' AS back, 'art_' || s_suppkey * 30 AS k FROM supplier
      UNION ALL SELECT 'art_' || s_suppkey * 30 || '-back' , 'art_' || s_suppkey * 30 FROM supplier),
lastb AS (SELECT k, max(back) AS back FROM b GROUP BY k),
named AS (SELECT front, back FROM f JOIN lastb USING (k)),
alone AS (SELECT front, row_number() OVER (ORDER BY front) AS n FROM f
          WHERE front NOT IN (SELECT front FROM named)),
spare AS (SELECT back, row_number() OVER (ORDER BY back) AS n FROM b
          WHERE back NOT IN (SELECT back FROM named))
SELECT front, back, 'name' AS how FROM named
UNION ALL SELECT front, back, 'position' FROM alone JOIN spare USING (n)""")
def pair_with_fallback(spark, sf_dir):
    fronts = table(spark, sf_dir, "part").filter("p_partkey % 2 = 0 or p_partkey > 500").select(
        F.concat(F.lit("art_"), F.col("p_partkey").cast("string"), F.lit("_front")).alias("stem"))
    number = (F.col("s_suppkey") * 30).cast("string")
    backs = table(spark, sf_dir, "supplier").select(F.explode(F.array(
        F.concat(F.lit("art_"), number, F.lit("_back")),
        F.concat(F.lit("art_"), number, F.lit("-back")))).alias("stem"))
    keyed = [df.withColumn("key", artwork.pair_key(F.col("stem"))) for df in (fronts, backs)]
    return pairing.pair(*keyed, "key", "stem")
