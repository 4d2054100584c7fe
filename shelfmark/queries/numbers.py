"""Numbers per day, counters, offsets and resume points."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import query, table
from ..functions import dates, names
from ..operators import numbering, ordered
from ..plans import board


def board_cards(spark, sf_dir):
    """Events as cards: the id starts with the hex epoch, half have a recorded action."""
    ts = F.col("ts")
    seconds = (F.datediff(ts, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
               + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lower(F.hex(seconds)), F.lpad(F.col("event_id").cast("string"), 16, "0"))
        .alias("id"),
        F.when(F.col("event_id") % 2 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .alias("action_time"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("[NTD010124A07] "), F.col("event_type")))
        .otherwise(F.col("event_type")).alias("name"), F.col("event_type").alias("list_name"))


_CARDS_SQL = """
cards AS (
  SELECT format('{:x}', CAST(epoch(date_trunc('second', ts)) AS BIGINT))
           || lpad(CAST(event_id AS VARCHAR), 16, '0') AS id, event_type,
         CASE WHEN event_id % 3 = 0 THEN '[NTD010124A07] ' || event_type ELSE event_type END AS name,
         CASE WHEN event_id % 2 = 0 THEN date_trunc('millisecond', ts)
              ELSE date_trunc('second', ts) END + INTERVAL 7 HOUR AS created_at
  FROM events),
counted AS (
  SELECT *, CAST(created_at AS DATE) AS day,
         row_number() OVER (PARTITION BY CAST(created_at AS DATE) ORDER BY created_at, id) AS counter
  FROM cards),
named AS (
  SELECT *, '[NTD' || strftime(day, '%d%m%y') || 'A'
              || CASE WHEN counter < 100 THEN lpad(CAST(counter AS VARCHAR), 2, '0')
                      ELSE CAST(counter AS VARCHAR) END || '] ' || event_type AS expected_name
  FROM counted)
"""


@query("daily_numbering", f"""WITH {_CARDS_SQL}
SELECT id, name, day, counter, expected_name FROM named WHERE name <> expected_name""")
def daily_numbering(spark, sf_dir):
    cards = board_cards(spark, sf_dir)
    return board.renumber_plan(cards, board.card_times(cards)).select(
        "id", "name", "day", "counter", "expected_name")


@query("next_counter", f"""WITH {_CARDS_SQL},
last AS (SELECT arg_max(expected_name, id) AS name, strftime(max(day), '%d%m%y') AS today
         FROM named)
SELECT CASE WHEN substring(name, 5, 6) = today
       THEN CAST(regexp_extract(name, 'A([0-9]+)\\]', 1) AS BIGINT) + 1 ELSE 1 END AS counter
FROM last""")
def next_counter(spark, sf_dir):
    cards = board_cards(spark, sf_dir)
    named = numbering.number_per_day(
        cards.withColumn("created_at", board.card_times(cards)), F.col("created_at"),
        [F.col("created_at"), F.col("id")], names.title_or_name(F.col("name")))
    today = named.agg(F.date_format(F.max("day"), "ddMMyy")).scalar()
    return numbering.next_counter(named, "expected_name", ["id"], today)


_SHOPS_SQL = """
shops AS (SELECT c_nationkey, min(c_custkey) AS pos, count(*) AS total,
                 CASE WHEN min(c_custkey) > 12 AND c_nationkey % 3 = 0 THEN count(*) // 2
                      WHEN min(c_custkey) > 20 THEN 0 ELSE count(*) END AS uploaded
          FROM customer GROUP BY c_nationkey),
o AS (SELECT *, sum(total) OVER (ORDER BY pos) - total AS start,
             sum(CASE WHEN uploaded < total OR uploaded = 0 THEN 1 ELSE 0 END)
               OVER (ORDER BY pos) AS shorts FROM shops),
f AS (SELECT c_nationkey, pos, total, uploaded, CAST(start AS BIGINT) AS start,
             uploaded >= total AND uploaded > 0 AS complete,
             shorts - CASE WHEN uploaded < total OR uploaded = 0 THEN 1 ELSE 0 END = 0 AS reached
      FROM o)
"""


def _offsets(spark, sf_dir):
    shops = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.min("c_custkey").alias("pos"), F.count(F.lit(1)).alias("total"))
    shops = shops.withColumn("uploaded", F.when(
        (F.col("pos") > 12) & (F.col("c_nationkey") % 3 == 0), F.floor(F.col("total") / 2))
        .when(F.col("pos") > 20, 0).otherwise(F.col("total")))
    return numbering.shop_offsets(shops, [F.col("pos")], "total", "uploaded")


@query("shop_offsets", f"""WITH {_SHOPS_SQL}
SELECT *, start + uploaded + 1 AS resume_row FROM f""")
def shop_offsets(spark, sf_dir):
    return _offsets(spark, sf_dir)


@query("resume_point", f"""WITH {_SHOPS_SQL}
SELECT coalesce(max(CASE WHEN reached THEN start + least(uploaded, total) END), 0) AS resume_at
FROM f""")
def resume_point(spark, sf_dir):
    return numbering.resume_point(_offsets(spark, sf_dir), "total", "uploaded")


@query("running_totals", """
SELECT o_orderkey, CAST(sum(o_custkey) OVER (PARTITION BY o_orderpriority
  ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM orders""")
def running_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                                 "o_orderdate")
    return ordered.running_sum(rows, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")],
                               ["o_orderpriority"]).select("o_orderkey", "running")


@query("board_times", """
SELECT event_id, CAST(date_trunc('millisecond', ts) AS DATE) AS utc_day,
       strftime(date_trunc('second', ts) + INTERVAL 7 HOUR, '%d%m%y %H:%M:%S') AS board_time
FROM events""")
def board_times(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    parsed = dates.time_of_iso(iso)
    local = dates.board_time(parsed)
    return table(spark, sf_dir, "events").select(
        "event_id", F.to_date(parsed).alias("utc_day"),
        F.concat(dates.day_code(local), F.date_format(local, " HH:mm:ss")).alias("board_time"))
