"""Listing records: API pages, metrics, tags, labels, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import query, table
from ..functions import labels, metrics, text
from ..operators import aggregates, containment, ranking
from ..operators.ordered import number_rows
from ..plans import runs
from ..sources import api_pages, checks
from ..values import MAX_LISTING_IMAGES, RANKINGS

# Sample taxonomy over the words that part names use.
NICHES = {"bolts": ["bolt", "screw"], "rings": ["RING"], "widgets": ["widget"], "empty": []}
SUB_NICHES = {
    "red things": {"parent": "widgets", "keywords": ["red"]},
    "blue things": {"keywords": ["blue"]},
    "small rings": {"parent": "rings", "keywords": ["small"]},
}
_NICHE_SQL = """CASE WHEN lower({0}) LIKE '%bolt%' OR lower({0}) LIKE '%screw%' THEN 'bolts'
  WHEN lower({0}) LIKE '%ring%' THEN 'rings' WHEN lower({0}) LIKE '%widget%' THEN 'widgets' END"""
_SUB_SQL = """CASE WHEN {1} = 'widgets' AND lower({0}) LIKE '%red%' THEN 'red things'
  WHEN lower({0}) LIKE '%blue%' THEN 'blue things'
  WHEN {1} = 'rings' AND lower({0}) LIKE '%small%' THEN 'small rings' END"""


@query("read_project_limit", """
SELECT c_custkey, c_name, nullif(c_mktsegment, 'FURNITURE') AS segment FROM customer
WHERE c_nationkey = 7 AND c_acctbal > 0 ORDER BY c_custkey LIMIT 20""")
def read_project_limit(spark, sf_dir):
    rows = checks.require(table(spark, sf_dir, "customer"), "c_custkey", "c_name")
    kept = rows.filter((F.col("c_nationkey") == 7) & (F.col("c_acctbal") > 0)).select(
        "c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    return ranking.first_rows(text.unlock(kept, ["segment"], ["FURNITURE"]),
                              [F.col("c_custkey")], 20)


@query("json_fields", r"""
SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS k FROM events""")
def json_fields(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", text.to_number(F.get_json_object("props", "$.k")).alias("k"))


_TOTALS_SQL = """
t AS (SELECT p_partkey, any_value(p_size) AS age, sum(l_quantity) * 100 AS views,
             count(l_orderkey) AS favorites, sum(l_linenumber) AS reviews
      FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey),
m AS (SELECT *, round(views / age, 1) AS vpm FROM t)"""


def _totals(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("favorites"),
        F.sum("l_linenumber").alias("reviews"))
    parts = table(spark, sf_dir, "part")
    return parts.join(lines, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "views", F.format_number(F.col("quantity") * 100, 0))


@query("listing_metrics", f"""WITH {_TOTALS_SQL}
SELECT p_partkey, vpm AS views_per_month, round(favorites / views, 4) AS engagement_rate,
       round(reviews / vpm, 4) AS competition_score FROM m""")
def listing_metrics(spark, sf_dir):
    views = text.to_number(F.col("views"))  # "12,300" as text
    monthly = metrics.views_per_month(views, F.col("p_size"))
    return _totals(spark, sf_dir).withColumn("monthly", monthly).select(
        "p_partkey", F.col("monthly").alias("views_per_month"),
        metrics.engagement_rate(F.col("favorites"), views).alias("engagement_rate"),
        metrics.competition_score(F.col("reviews"), F.col("monthly"), 4).alias(
            "competition_score"))


@query("search_api_pages", f"""
WITH b AS (SELECT *, replace(p_name, ' ', '; ') || '; ' || p_type AS tags FROM part),
n AS (SELECT *, {_NICHE_SQL.format('tags')} AS niche FROM b)
SELECT CAST(p_partkey AS VARCHAR) AS listing_id, p_name AS product, p_brand AS shop_name,
       CAST(p_size * 100 AS VARCHAR) AS total_views, tags,
       CASE p_partkey % 3 WHEN 0 THEN 'small' || p_partkey WHEN 1 THEN 'plain' || p_partkey
         ELSE 'icon' || p_partkey END AS image_url,
       CASE WHEN p_size % 4 > 0 THEN round(p_size * 100.0 / (p_size % 4), 1) END
         AS views_per_month,
       CASE WHEN p_partkey % 2 = 0 THEN '7' END AS mo_sales, niche,
       {_SUB_SQL.format('tags', 'niche')} AS sub_niche FROM n""")
def search_api_pages(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    images = F.when(F.col("p_partkey") % 3 == 0, F.concat(
        F.lit('[{"url_170x135": "small'), key, F.lit('", "url": "big"}]'))).when(
        F.col("p_partkey") % 3 == 1, F.concat(F.lit('["plain'), key, F.lit('"]')))
    item = F.struct(
        key.alias("listing_id"), F.col("p_name").alias("title"),
        (F.col("p_size") % 4).cast("string").alias("listing_age_in_months"),
        (F.col("p_size") * 100).cast("string").alias("views"),
        F.lit("5").alias("num_favorers"), F.lit("3").alias("est_reviews"),
        F.when(F.col("p_partkey") % 2 == 0, "7").otherwise("Please upgrade").alias("est_mo_sales"),
        F.struct(F.col("p_brand").alias("shop_name")).alias("shop"),
        F.concat(F.split("p_name", " "), F.array(F.lit("")), F.array(F.concat(
            F.lit(" "), F.col("p_type")))).alias("tags"),
        images.alias("Images"), F.concat(F.lit("icon"), key).alias("icon_url_fullxfull"))
    body = F.to_json(F.struct(F.array(item).alias("results")))
    schema = ("results array<struct<listing_id:string,title:string,listing_age_in_months:string,"
              "views:string,num_favorers:string,est_reviews:string,est_mo_sales:string,"
              "shop:struct<shop_name:string>,tags:array<string>,Images:string,"
              "icon_url_fullxfull:string>>")
    pages = table(spark, sf_dir, "part").select(F.from_json(body, schema).alias("p")).select("p.*")
    return api_pages.search_listings(pages, NICHES, SUB_NICHES).select(
        "listing_id", "product", "shop_name", "total_views", "tags", "image_url",
        "views_per_month", "mo_sales", "niche", "sub_niche")


@query("api_record_variants", """
SELECT CAST(p_partkey AS VARCHAR) AS listing_id,
       CASE p_partkey % 4 WHEN 0 THEN 'a; ' || p_brand WHEN 1 THEN p_brand WHEN 2 THEN p_brand || '; b' END
         AS tags,
       CASE p_partkey % 4 WHEN 0 THEN 'small' || p_partkey WHEN 1 THEN 'full' || p_partkey
         ELSE 'icon' || p_partkey END AS image_url
FROM part""")
def api_record_variants(spark, sf_dir):
    """Two services: one sends typed arrays under a lower-case name, the other texts and lists as text."""
    key = F.col("p_partkey").cast("string")
    first = table(spark, sf_dir, "part").where(F.col("p_partkey") % 4 == 0).select(F.array(F.struct(
        key.alias("listing_id"), F.array(F.lit(" a"), F.lit(""), F.col("p_brand")).alias("tags"),
        F.array(F.struct(F.concat(F.lit("small"), key).alias("url_170x135"))).alias("images"),
        F.concat(F.lit("icon"), key).alias("icon_url_fullxfull"))).alias("results"))
    kind = F.col("p_partkey") % 4
    second = table(spark, sf_dir, "part").where(kind != 0).select(F.array(F.struct(
        key.alias("listing_id"),
        F.when(kind == 1, F.col("p_brand")).when(kind == 2, F.to_json(F.array("p_brand", F.lit(" b "))))
        .alias("tags"),
        F.when(kind == 1, F.concat(F.lit('[{"url_fullxfull": "full'), key, F.lit('"}]')))
        .when(kind == 2, "bare text").otherwise("[]").alias("Images"),
        F.concat(F.lit("icon"), key).alias("icon_url_fullxfull"))).alias("results"))
    found = [api_pages.search_listings(pages).select("listing_id", "tags", "image_url")
             for pages in (first, second)]
    return found[0].unionByName(found[1])


def _shop_pages(spark, sf_dir):
    """One API page per order; only the first page of a customer carries shop details."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_custkey").cast("string")
    details = F.when(F.col("o_orderkey") % 10 == 0, F.struct(
        F.concat(F.lit("Shop "), key).alias("shop_name"), F.col("o_custkey").alias("shop_id"),
        F.col("o_totalprice").alias("revenue"), F.lit("Please upgrade").alias("growth")))
    item = F.struct(
        F.col("o_orderkey").alias("listing_id"), F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderstatus") == "P", " Please upgrade ").otherwise(
            F.col("o_orderstatus")).alias("state"),
        F.array(F.lit(" a "), F.lit(""), F.col("o_orderstatus")).alias("tags"),
        F.concat(F.lit("img"), F.col("o_orderkey").cast("string")).alias("Images"))
    return orders.select("o_custkey", details.alias("shop_details"),
                         F.array(item, item).alias("results"))


@query("shop_api_shops", """
SELECT 'Shop ' || o_custkey AS shop_name, o_custkey AS shop_id, o_totalprice AS shop_revenue
FROM orders WHERE o_orderkey % 10 = 0""")
def shop_api_shops(spark, sf_dir):
    return api_pages.shops(_shop_pages(spark, sf_dir)).select(
        "shop_name", "shop_id", "shop_revenue")


@query("shop_api_listings", """
SELECT CAST(o_custkey AS VARCHAR) AS shop_name, o_orderkey AS listing_id, o_orderpriority AS title,
       'a, ' || o_orderstatus AS tags, 'img' || o_orderkey AS image_url,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS state, count(*) AS n
FROM orders, (VALUES (1), (2)) twice(x) GROUP BY ALL""")
def shop_api_listings(spark, sf_dir):
    rows = api_pages.shop_listings(_shop_pages(spark, sf_dir), F.col("o_custkey").cast("string"))
    return rows.groupBy("shop_name", "listing_id", "title", "tags", "image_url", "state").agg(
        F.count(F.lit(1)).alias("n"))


@query("taxonomy_label", f"""
SELECT p_partkey, {_NICHE_SQL.format('p_name')} AS niche FROM part
UNION ALL SELECT -1 - doc_id, {_NICHE_SQL.format('text')} FROM documents""")
def taxonomy_label(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("words"))
    docs = table(spark, sf_dir, "documents").select((-1 - F.col("doc_id")).alias("p_partkey"),
                                                    F.col("text").alias("words"))
    return parts.union(docs).select("p_partkey", labels.niche(F.col("words"), NICHES)
                                    .alias("niche"))


# Words of the benchmark passages as a keyword table, thousands of them: a passage is a label, and
# every second one stands below the passage before it.
_TABLE_SQL = r"""
words AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-zà-ÿ]+'))) AS keyword
          FROM benchmark),
tax AS (SELECT item_id AS ord, 'p' || item_id AS label, keyword,
               CASE WHEN item_id % 2 = 1 THEN 'p' || (item_id - 1) END AS parent
        FROM words WHERE length(keyword) >= 2 AND length(keyword) % 3 = 0),
texts AS (SELECT doc_id, lower(text) AS lowered FROM documents),
found AS (SELECT doc_id, keyword FROM texts JOIN (SELECT DISTINCT keyword FROM tax) k
          ON contains(lowered, keyword)),
hit AS (SELECT DISTINCT doc_id, ord, label, parent FROM found JOIN tax USING (keyword)),
top AS (SELECT t.doc_id, arg_min(label, ord) AS niche FROM texts t LEFT JOIN hit h
        ON h.doc_id = t.doc_id AND parent IS NULL GROUP BY t.doc_id)
SELECT top.doc_id, any_value(niche) AS niche, arg_min(label, ord) AS sub_niche
FROM top LEFT JOIN hit h ON h.doc_id = top.doc_id AND h.parent = top.niche GROUP BY top.doc_id"""


@query("taxonomy_table", "WITH " + _TABLE_SQL)
def taxonomy_table(spark, sf_dir):
    words = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit("[a-zà-ÿ]+"), F.lit(0)))).alias("keyword"))
    taxonomy = words.where((F.length("keyword") >= 2) & (F.length("keyword") % 3 == 0)).select(
        F.col("item_id").alias("ord"), F.concat(F.lit("p"), "item_id").alias("label"), "keyword",
        F.when(F.col("item_id") % 2 == 1, F.concat(F.lit("p"), F.col("item_id") - 1)).alias("parent"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return containment.table_labels(docs, "doc_id", "text", taxonomy)


@query("taxonomy_sublabel", f"""
WITH n AS (SELECT *, {_NICHE_SQL.format('p_name')} AS niche FROM part)
SELECT p_partkey, niche, {_SUB_SQL.format('p_name', 'niche')} AS sub_niche FROM n""")
def taxonomy_sublabel(spark, sf_dir):
    return table(spark, sf_dir, "part").withColumn(
        "niche", labels.niche(F.col("p_name"), NICHES)).select(
        "p_partkey", "niche", labels.sub_niche(F.col("p_name"), F.col("niche"), SUB_NICHES)
        .alias("sub_niche"))


@query("tag_normalise", r"""
SELECT p_partkey, replace(p_name, ' ', ', ') || ', ' || p_type AS normal,
       replace(p_name, ' ', '; ') || '; ' || p_brand AS joined,
       CASE WHEN string_split(p_name, ' ')[1] = string_split(p_name, ' ')[2] THEN
         string_split(p_name, ' ')[1] ELSE replace(p_name, ' ', '|') END || '|' || p_brand AS spelled
FROM part""")
def tag_normalise(spark, sf_dir):
    words = F.split("p_name", " ")
    raw = F.concat(F.array_join(words, " ;"), F.lit(",, "), F.col("p_type"), F.lit(" ;"))
    listed = F.concat(words, F.array(F.lit("")), F.array(F.concat(F.col("p_brand"), F.lit(" "))))
    twice = F.concat(words, F.transform(words, lambda w: F.upper(w)),
                     F.array(F.col("p_brand"), F.lower("p_brand")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.normal_tags(raw).alias("normal"),
        text.tags_from_array(listed).alias("joined"),
        F.array_join(text.distinct_ignoring_case(twice), "|").alias("spelled"))


_RANK_SQL = """
m AS (SELECT p_partkey, sum(l_quantity) AS views, any_value(p_retailprice) AS est_mo_revenue,
             count(*) AS reviews, count(DISTINCT l_orderkey) AS favorites,
             any_value(p_size) AS listing_age, count(*) FILTER (l_tax > 0.04) AS est_reviews,
             count(*) FILTER (l_linestatus = 'O') AS est_reviews_in_months,
             count(DISTINCT l_suppkey) AS transaction_sold_count
      FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey)"""


def _rank_source(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("views"), F.count(F.lit(1)).alias("reviews"),
        F.countDistinct("l_orderkey").alias("favorites"),
        F.count_if(F.col("l_tax") > 0.04).alias("est_reviews"),
        F.count_if(F.col("l_linestatus") == "O").alias("est_reviews_in_months"),
        F.countDistinct("l_suppkey").alias("transaction_sold_count"))
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_retailprice").alias("est_mo_revenue"),
        F.col("p_size").alias("listing_age"))
    return parts.join(lines, F.col("p_partkey") == F.col("l_partkey"))


def _walk_sql(per_ranking):
    parts = [f"""SELECT p_partkey, {i} AS ranking, row_number() OVER (
        ORDER BY CAST({column} AS DOUBLE) {direction.upper()}, p_partkey) AS rank FROM m"""
             for i, (column, direction) in enumerate(RANKINGS)]
    return f"""r AS ({' UNION ALL '.join(parts)}),
met AS (SELECT p_partkey, ranking, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY ranking, rank) AS rn
  FROM r WHERE rank <= {per_ranking}) WHERE rn = 1)"""


@query("multi_rank_topk", f"""WITH {_RANK_SQL}, {_walk_sql(60)}
SELECT p_partkey, ranking, rank FROM met""")
def multi_rank_topk(spark, sf_dir):
    return ranking.union_of_rankings(_rank_source(spark, sf_dir), "p_partkey", RANKINGS, 60)


@query("multi_rank_until_enough", f"""WITH {_RANK_SQL}, {_walk_sql(100)},
pg AS (SELECT ranking, (rank - 1) // 20 AS page, count(*) AS n FROM met GROUP BY ALL),
known AS (SELECT *, coalesce(sum(n) OVER (ORDER BY ranking, page
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pg)
SELECT p_partkey, met.ranking, rank FROM met JOIN known
  ON known.ranking = met.ranking AND known.page = (rank - 1) // 20 WHERE before < 250""")
def multi_rank_until_enough(spark, sf_dir):
    return ranking.union_of_rankings(_rank_source(spark, sf_dir), "p_partkey", RANKINGS, 100,
                                     max_rows=250)


@query("page_slices", """
SELECT o_orderkey, (rn - 1) // 20 + 1 AS page FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)""")
def page_slices(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.pages(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20).drop(
        "o_totalprice")


@query("batch_groups", """
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 40 AS batch FROM orders""")
def batch_groups(spark, sf_dir):
    return ranking.batches(table(spark, sf_dir, "orders").select("o_orderkey"),
                           [F.col("o_orderkey")])


@query("rows_from_start", """
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn
                        FROM orders) WHERE rn > 1000""")
def rows_from_start(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ranking.rows_from(rows, [F.col("o_orderdate"), F.col("o_orderkey")], 1000).drop(
        "o_orderdate")


@query("schema_drift_union", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def schema_drift_union(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("array_union_by_key", """
SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY o, l, l_suppkey) AS position
FROM (SELECT l_partkey, l_suppkey, min(l_orderkey) AS o, arg_min(l_linenumber,
        l_orderkey * 1000 + l_linenumber) AS l FROM lineitem GROUP BY ALL)""")
def array_union_by_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey",
                                                   "l_linenumber")
    items = aggregates.distinct_items(rows, "l_partkey", "l_suppkey",
                                      ["l_orderkey", "l_linenumber"])
    order = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")]
    return number_rows(items, order, ["l_partkey"], "position").select(
        "l_partkey", "l_suppkey", "position")


@query("first_twenty_items", """
SELECT l_suppkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY rn) AS items FROM (
  SELECT l_suppkey, l_partkey, row_number() OVER (
    PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS rn
  FROM lineitem) WHERE rn <= 20 GROUP BY l_suppkey""")
def first_twenty_items(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_partkey").cast("string").alias("part"), "l_shipdate", "l_orderkey",
        "l_linenumber", "l_partkey")
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")]
    found = aggregates.first_items(rows, "l_suppkey", "part", order, MAX_LISTING_IMAGES)
    return found.select("l_suppkey", F.array_join("items", ",").alias("items"))


@query("all_items_in_order", """
SELECT l_suppkey, l_partkey, row_number() OVER (
  PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS position
FROM lineitem""")
def all_items_in_order(spark, sf_dir):
    keys = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", *keys)
    return aggregates.items_in_order(rows, "l_suppkey", "l_partkey", [F.col(c) for c in keys])


@query("listings_from_pages", """
SELECT CAST(listing_id AS VARCHAR) AS listing_id, product, shop_name, total_views FROM (
  SELECT o_custkey AS listing_id, o_orderpriority AS product, o_orderstatus AS shop_name,
         CAST(o_orderkey AS VARCHAR) AS total_views,
         row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def listings_from_pages(spark, sf_dir):
    def item(views):
        return F.struct(
            F.col("o_custkey").cast("string").alias("listing_id"),
            F.col("o_orderpriority").alias("title"), views.cast("string").alias("views"),
            F.struct(F.col("o_orderstatus").alias("shop_name")).alias("shop"))

    key = F.col("o_orderkey")
    pages = table(spark, sf_dir, "orders").select("o_orderkey", F.array(
        item(key), item(key + 1)).alias("results"))
    return runs.listings_from_pages(pages, [F.col("o_orderkey")]).select(
        "listing_id", "product", "shop_name", "total_views")
