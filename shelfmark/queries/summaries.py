"""Counts, medians and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import query, table
from ..functions import urls
from ..operators import aggregates
from ..operators.ordered import number_rows
from ..plans import artwork as artwork_plans


def _log(spark, sf_dir):
    """Events as a run log: status, side and elapsed seconds."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.when(kind == "purchase", "done").when(kind == "view", "skipped")
        .when(kind == "error", "failed").when(kind == "click", "download_failed")
        .otherwise("no_back").alias("status"),
        F.when(kind != "error", F.col("value")).alias("elapsed"))


_FAILED = ["failed", "download_failed", "invalid_coords"]


def _rounded(counts):
    # The last bits of a sum of doubles depend on the order of adding.
    return counts.withColumn("mean_elapsed", F.round("mean_elapsed", 8))


_STATUS_SQL = """
SELECT count(*) FILTER (event_type = 'purchase') AS done,
       count(*) FILTER (event_type = 'view') AS skipped,
       count(*) FILTER (event_type IN ('error', 'click')) AS failed, count(*) AS total,
       coalesce(round(avg(value) FILTER (event_type = 'purchase'), 8), 0) AS mean_elapsed {0}
FROM events {1}"""


@query("status_summary", _STATUS_SQL.format("", ""))
def status_summary(spark, sf_dir):
    return _rounded(aggregates.status_counts(_log(spark, sf_dir), "status", "elapsed", _FAILED))


@query("status_summary_per_user", _STATUS_SQL.format(", user_id", "GROUP BY user_id"))
def status_summary_per_user(spark, sf_dir):
    return _rounded(aggregates.status_counts(_log(spark, sf_dir), "status", "elapsed", _FAILED,
                                             ["user_id"]))


@query("done_rows", "SELECT event_id, value AS elapsed FROM events WHERE event_type = 'purchase'")
def done_rows(spark, sf_dir):
    return aggregates.done_rows(_log(spark, sf_dir), "status").select("event_id", "elapsed")


@query("found_counts", """
SELECT count(*) FILTER (p_size % 4 > 0) AS found, count(*) FILTER (p_size % 4 = 0) AS missing,
       max(p_size % 4) AS most_images FROM part""")
def found_counts(spark, sf_dir):
    images = F.when(F.col("p_size") % 4 > 0, F.array_repeat(F.col("p_name"), (
        F.col("p_size") % 4).cast("int")))
    return aggregates.found_counts(table(spark, sf_dir, "part"), images)


@query("count_per_group_with_empty", """
SELECT n_nationkey, n_name, count(c_custkey) AS cards FROM nation
LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 9500 GROUP BY ALL""")
def count_per_group_with_empty(spark, sf_dir):
    cards = table(spark, sf_dir, "customer").filter("c_acctbal > 9500").select(
        F.col("c_nationkey").alias("n_nationkey"))
    return aggregates.count_per_group(table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_name"), cards, "n_nationkey", "cards")


@query("groups_in_first_order", """
SELECT c_nationkey, min(c_custkey) AS first_at, count(*) AS n FROM customer GROUP BY c_nationkey""")
def groups_in_first_order(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    return aggregates.groups_in_order(rows, "c_nationkey", "c_custkey").orderBy("first_at")


@query("listings_beside_cards", """
SELECT c_nationkey, count(*) AS n, min(c_custkey) AS first_at, any_value(coalesce(s.cards, 0)) AS cards
FROM customer LEFT JOIN (SELECT s_nationkey, count(*) AS cards FROM supplier GROUP BY 1) s
  ON s_nationkey = c_nationkey GROUP BY c_nationkey""")
def listings_beside_cards(spark, sf_dir):
    shops = aggregates.groups_in_order(table(spark, sf_dir, "customer"), "c_nationkey",
                                       "c_custkey")
    cards = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("c_nationkey"))
    return aggregates.count_per_group(shops, cards, "c_nationkey", "cards")


@query("fallback_names", """
SELECT DISTINCT coalesce(nullif(trim(CASE WHEN turn % 2 = 0 THEN ' ' ELSE role END), ''),
                         nullif(trim(text), '')) AS name
FROM conversations""")
def fallback_names(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        F.when(F.col("turn") % 2 == 0, " ").otherwise(F.col("role")).alias("main"), "text")
    return aggregates.fallback_names(rows, "main", "text")


@query("exact_median", """
SELECT l_suppkey, count(*) AS n, median(l_quantity) AS median FROM lineitem
GROUP BY l_suppkey HAVING count(*) >= 5""")
def exact_median(spark, sf_dir):
    return aggregates.exact_median(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity", 5)


@query("robust_tilt", """
WITH s AS (SELECT l_partkey, l_linenumber AS x1, l_quantity AS y1, l_suppkey % 20 AS x2,
                  l_discount * 500 AS y2 FROM lineitem),
a AS (SELECT l_partkey, count(*) OVER (PARTITION BY l_partkey) AS all_n, x1, x2,
             degrees(atan2(y2 - y1, x2 - x1)) AS angle FROM s),
k AS (SELECT l_partkey, all_n, angle + 45 - 90 * floor((angle + 45) / 90) - 45 AS angle FROM a
      WHERE x1 <> x2 AND abs(angle) <= 70)
SELECT l_partkey, count(*) AS n, round(median(angle), 1) AS tilt FROM k
GROUP BY l_partkey HAVING count(*) >= 5 AND any_value(all_n) >= 5""")
def robust_tilt(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.col("l_linenumber").alias("x1"), F.col("l_quantity").alias("y1"),
        (F.col("l_suppkey") % 20).alias("x2"), (F.col("l_discount") * 500).alias("y2"))
    return aggregates.robust_tilt(lines, "l_partkey", "x1", "y1", "x2", "y2")


@query("natural_sort", """
SELECT l_partkey, 'image_' || l_linenumber * 7 || '_' || l_orderkey AS name,
       row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber,
                          'image_' || l_linenumber * 7 || '_' || l_orderkey) AS position
FROM (SELECT DISTINCT l_partkey, l_linenumber, l_orderkey FROM lineitem)""")
def natural_sort(spark, sf_dir):
    name = F.concat(F.lit("image_"), (F.col("l_linenumber") * 7).cast("string"), F.lit("_"),
                    F.col("l_orderkey").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", name.alias("name")).distinct()
    return number_rows(rows, [urls.number_in(F.col("name")), F.col("name")], ["l_partkey"],
                       "position").select("l_partkey", "name", "position")


@query("min_resolution", """
SELECT p_partkey AS listing_id, i AS image_index, p_name || i AS url
FROM part, (VALUES (1), (2), (3)) v(i)
WHERE p_size * 25 * i >= 1028 AND p_retailprice * 1.1 + i >= 1028""")
def min_resolution(spark, sf_dir):
    def image(i):
        return F.struct(F.concat(F.col("p_name"), F.lit(str(i))).alias("url"),
                        (F.col("p_size") * 25 * i).alias("width"),
                        (F.col("p_retailprice") * 1.1 + i).alias("height"))

    images = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("listing_id"), F.array(image(1), image(2), image(3))
        .alias("images"))
    return artwork_plans.large_images(images)


@query("count_beside_rows", """
SELECT event_id, CASE WHEN user_id % 7 > 0 THEN user_id END AS user_key,
       CASE WHEN user_id % 7 > 0 THEN count(*) OVER (PARTITION BY user_id) END AS n FROM events""")
def count_beside_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.when(
        F.col("user_id") % 7 > 0, F.col("user_id")).alias("user_key"))
    return aggregates.with_group_size(rows, "user_key")


@query("run_progress", """
SELECT count(*) AS total, count(o) AS done, count(*) - count(o) AS remaining FROM customer
LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders WHERE o_orderstatus = 'F') ON o = c_custkey""")
def run_progress(spark, sf_dir):
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("c_custkey"))
    return aggregates.progress(table(spark, sf_dir, "customer"), done, "c_custkey")
