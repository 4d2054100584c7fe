"""Upload plans and name audits against a board of cards."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import query, table
from ..functions.names import card_key
from ..plans import board

# Listings: customers under their nation. Titles repeat within a nation, so that a later listing
# meets the card made for an earlier one. Cards: suppliers and some earlier uploads.
_LISTINGS_SQL = """
listings AS (
  SELECT 'Shop ' || c_nationkey AS shop_name, CAST(c_custkey AS VARCHAR) AS listing_id,
         CASE WHEN c_custkey % 10 > 0 THEN c_mktsegment || ' ' || c_custkey % 7 ELSE '' END AS raw,
         CASE WHEN c_custkey % 10 > 0 THEN c_mktsegment || ' ' || c_custkey % 7
              ELSE CAST(c_custkey AS VARCHAR) END AS title,
         c_mktsegment || ', x' AS tags, c_custkey % 4 AS n_images, c_custkey AS seq
  FROM customer),
cards AS (
  SELECT 'Shop ' || c_nationkey AS list_name, CAST(c_custkey AS VARCHAR) AS id,
         CASE c_custkey % 3 WHEN 0 THEN '[NTD010124A01] ' || c_mktsegment || ' ' || c_custkey % 7
              WHEN 1 THEN c_mktsegment || ' ' || c_custkey % 7 ELSE 'other' END AS name,
         CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ', x'
              ELSE '**Title:** ' || c_mktsegment || ' ' || c_custkey % 7 || chr(10) || chr(10)
                   || '**Tags:** a; b' END AS descr,
         c_custkey % 3 AS attachment_count, c_custkey AS pos
  FROM customer WHERE c_acctbal > 7000)
"""


def _listings(spark, sf_dir):
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Shop "), F.col("c_nationkey").cast("string")).alias("shop_name"),
        key.cast("string").alias("listing_id"),
        F.when(key % 10 > 0, F.concat(F.col("c_mktsegment"), F.lit(" "), (key % 7).cast("string")))
        .otherwise("").alias("title"),
        F.concat(F.col("c_mktsegment"), F.lit(", x")).alias("tags"),
        (key % 4).alias("n_images"), key.alias("seq"))


def _cards(spark, sf_dir):
    key = F.col("c_custkey")
    title = F.concat(F.col("c_mktsegment"), F.lit(" "), (key % 7).cast("string"))
    return table(spark, sf_dir, "customer").filter("c_acctbal > 7000").select(
        F.concat(F.lit("Shop "), F.col("c_nationkey").cast("string")).alias("list_name"),
        key.cast("string").alias("id"),
        F.when(key % 3 == 0, F.concat(F.lit("[NTD010124A01] "), title)).when(key % 3 == 1, title)
        .otherwise("other").alias("name"),
        F.when(key % 2 == 0, F.concat(F.col("c_mktsegment"), F.lit(", x"))).otherwise(
            F.concat(F.lit("**Title:** "), title, F.lit("\n\n**Tags:** a; b"))).alias("desc"),
        (key % 3).alias("attachment_count"), key.alias("pos"))


def _plan_sql(match, new_desc, action, extra):
    """Sequential rule: the card found on the board, else the card an earlier listing made."""
    return f"""WITH {_LISTINGS_SQL},
hits AS (
  SELECT l.seq, arg_min(c.descr, c.pos) AS descr, arg_min(c.attachment_count, c.pos) AS att,
         min(c.pos) AS pos
  FROM listings l JOIN cards c ON c.list_name = l.shop_name AND ({match}) GROUP BY l.seq),
j AS (
  SELECT l.*, {new_desc} AS new_desc, hits.descr, hits.att, hits.pos,
         min(l.seq) OVER (PARTITION BY l.shop_name) AS shop_at,
         row_number() OVER (PARTITION BY l.shop_name, l.title ORDER BY l.seq) AS nth
  FROM listings l LEFT JOIN hits USING (seq)),
w AS (
  SELECT *, pos IS NOT NULL OR nth > 1 AS present,
         CASE WHEN pos IS NOT NULL THEN att WHEN nth > 1 THEN 0 END AS have,
         CASE WHEN pos IS NOT NULL THEN descr WHEN nth > 1
              THEN first_value(new_desc) OVER (PARTITION BY shop_name, title ORDER BY seq) END AS old
  FROM j),
a AS (SELECT *, {action} AS action FROM w)
SELECT listing_id, action, pos AS card, CAST(sum(CASE WHEN action <> 'skip' THEN 1 ELSE 0 END) OVER (
         ORDER BY shop_at, seq) - CASE WHEN action <> 'skip' THEN 1 ELSE 0 END + 5 AS BIGINT)
         AS counter
       {extra} FROM a"""


@query("upload_plan", _plan_sql(
    r"c.name = l.title OR regexp_extract(c.name, '(?s)^\[.*?\]\s*(.+)', 1) = l.title",
    "tags", """CASE WHEN NOT present THEN 'create' WHEN have >= n_images THEN 'skip'
                 ELSE 'reattach' END""",
    ", present AND NOT (NOT contains(old, '**Title:**') AND old = new_desc) AS update_desc"))
def upload_plan(spark, sf_dir):
    plan = board.upload_plan(_listings(spark, sf_dir), _cards(spark, sf_dir), 5)
    return plan.select("listing_id", "action", F.col("card_id").cast("bigint").alias("card"),
                       "counter", "update_desc")


@query("upload_plan_any", _plan_sql(
    r"c.name = l.title OR trim(regexp_extract(c.descr, '^\*\*Title:\*\*\s*(.+)', 1)) = l.title",
    "tags", """CASE WHEN NOT present THEN 'create' WHEN have > 0 THEN 'skip'
                 ELSE 'reattach' END""",
    ", '**Title:** ' || title || chr(10) || chr(10) || '**Tags:** ' || tags AS new_desc"))
def upload_plan_any(spark, sf_dir):
    listings = _listings(spark, sf_dir).withColumn("url", F.lit(None).cast("string"))
    plan = board.upload_plan_any(listings, _cards(spark, sf_dir), 5)
    return plan.select("listing_id", "action", F.col("card_id").cast("bigint").alias("card"),
                       "counter", "new_desc")


@query("name_exists_plan", """
WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey || ' — '
             || substring(repeat(o_orderpriority || ' ', 9), 1, 60)
             ELSE substring(repeat(o_orderpriority || ' ', 9), 1, 80) END AS name FROM orders)
SELECT o_orderkey, name, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 4 = 0 AND EXISTS (
    SELECT 1 FROM l k WHERE k.name = l.name AND k.o_orderkey % 3 = 0) THEN 'skip' ELSE 'create' END
  AS action FROM l""")
def name_exists_plan(spark, sf_dir):
    key = F.col("o_orderkey")
    listings = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 4 > 0, key.cast("string")).otherwise("").alias("listing_id"),
        F.repeat(F.concat(F.col("o_orderpriority"), F.lit(" ")), F.lit(9)).alias("title"))
    known = listings.filter(key % 3 == 0).select(
        card_key(F.col("listing_id"), F.col("title")).alias("name"))
    return board.upload_plan_by_name(listings, known).select("o_orderkey", "name", "action")


def _audit_cards(spark, sf_dir):
    key = F.col("p_partkey")
    sku = F.concat(F.lit("NTD010124A"), key.cast("string"))
    name = (F.when(key % 4 == 0, F.concat(F.lit("["), sku, F.lit("] "), F.col("p_name")))
            .when(key % 4 == 1, sku).when(key % 4 == 2, F.concat(
                F.lit("["), sku, F.lit("] Old "), F.col("p_type"))).otherwise(F.col("p_name")))
    desc = (F.when(key % 5 == 0, "").when(key % 5 == 1, F.concat(
        F.lit("**Title:** "), F.col("p_name"), F.lit("\n\n**Tags:** a; b ,c\n\n**Etsy URL:** u")))
        .when(key % 5 == 2, F.concat(F.lit("**Title:** "), F.col("p_name")))
        .when(key % 5 == 3, F.concat(F.lit("x **Tags:** "), F.col("p_type"), F.lit(";")))
        .otherwise("plain"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), desc.alias("desc"))


_AUDIT_SQL = """
c AS (
  SELECT p_partkey, p_name, p_type, 'NTD010124A' || p_partkey AS sku0, p_partkey % 4 AS nk,
         p_partkey % 5 AS dk FROM part),
k AS (
  SELECT *, CASE nk WHEN 0 THEN '[' || sku0 || '] ' || p_name WHEN 1 THEN sku0
              WHEN 2 THEN '[' || sku0 || '] Old ' || p_type ELSE p_name END AS name,
         CASE WHEN nk < 3 THEN sku0 END AS sku,
         CASE WHEN dk IN (1, 2) THEN p_name END AS title,
         CASE WHEN dk = 1 THEN 'a, b, c' WHEN dk = 3 THEN p_type ELSE '' END AS want
  FROM c),
o AS (
  SELECT *, name = '[' || sku || '] ' || title AS name_good FROM k),
t AS (SELECT p_name AS title, arg_max(p_type, p_partkey) AS csv_tags FROM part
      WHERE p_partkey % 3 = 0 GROUP BY 1)
"""


@query("name_audit", f"""WITH {_AUDIT_SQL}
SELECT p_partkey, sku, CASE WHEN sku IS NULL THEN 'no_sku' WHEN title IS NULL THEN 'no_title'
         WHEN name_good THEN 'desc' ELSE 'name,desc' END AS outcome,
       CASE WHEN sku IS NOT NULL AND title IS NOT NULL AND NOT name_good
            THEN '[' || sku || '] ' || title END AS new_name,
       CASE WHEN sku IS NOT NULL AND title IS NOT NULL THEN want END AS new_desc FROM o""")
def name_audit(spark, sf_dir):
    return board.name_audit(_audit_cards(spark, sf_dir)).drop("name", "desc")


@query("description_audit", f"""WITH {_AUDIT_SQL},
e AS (SELECT o.*, t.csv_tags FROM o LEFT JOIN t ON dk = 0 AND t.title = CASE nk
        WHEN 0 THEN p_name WHEN 2 THEN 'Old ' || p_type END)
SELECT p_partkey, sku,
       CASE WHEN sku IS NULL THEN 'no_sku' WHEN dk = 0 AND csv_tags IS NOT NULL
            THEN 'added_from_csv' WHEN title IS NULL THEN 'no_title'
            WHEN name_good THEN 'desc' ELSE 'name,desc' END AS outcome,
       CASE WHEN sku IS NOT NULL AND title IS NOT NULL AND NOT name_good
            THEN '[' || sku || '] ' || title END AS new_name,
       CASE WHEN sku IS NOT NULL AND dk = 0 THEN csv_tags
            WHEN sku IS NOT NULL AND title IS NOT NULL THEN want END AS new_desc FROM e""")
def description_audit(spark, sf_dir):
    rows = table(spark, sf_dir, "part").filter("p_partkey % 3 = 0").select(
        F.concat(F.lit(" "), F.col("p_name")).alias("title"),
        F.concat(F.col("p_type"), F.lit(" ; ")).alias("tags"), "p_partkey")
    return board.name_audit(_audit_cards(spark, sf_dir),
                            board.tags_by_title(rows, "p_partkey")).drop("name", "desc")


@query("hidden_cards", """
SELECT c_custkey, c_custkey || ' — ' || c_name AS name,
       CASE WHEN c_custkey % 4 = 0 THEN 'skip' ELSE 'create' END AS action,
       '**Listing ID:** ' || c_custkey || chr(10) || chr(10)
         || CASE WHEN c_custkey % 3 > 0 THEN '**Etsy URL:** u' || c_custkey || chr(10) || chr(10)
            ELSE '' END || '**Status:** Unavailable' AS descr FROM customer""")
def hidden_cards(spark, sf_dir):
    key = F.col("c_custkey")
    hidden = table(spark, sf_dir, "customer").select(
        "c_custkey", key.cast("string").alias("listing_id"), F.col("c_name").alias("title"),
        F.when(key % 3 > 0, F.concat(F.lit("u"), key.cast("string"))).otherwise("")
        .alias("etsy_url"))
    known = hidden.filter(key % 4 == 0).select(
        card_key(F.col("listing_id"), F.col("title")).alias("name"))
    return board.hidden_cards(hidden, known).select("c_custkey", "name", "action",
                                                    F.col("desc").alias("descr"))
