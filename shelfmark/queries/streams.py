"""Incremental runs over tables that arrive in slices.

Each slice is added to a landing folder and followed by one run, as a nightly job would be. The
result must equal the batch result over the whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import query, table
from .. import scratch
from ..streaming import incremental, seen

SLICES = 3


def _in_slices(spark, rows, position, run):
    """Land the table slice by slice in ``position`` order; run after every slice."""
    folder = scratch.fresh(spark, "stream")
    low, high = rows.agg(F.min(position), F.max(position)).first()
    step = (high - low) // SLICES + 1
    for number in range(SLICES):
        start = low + number * step
        rows.filter((F.col(position) >= start) & (F.col(position) < start + step)).write.mode(
            "append").parquet(f"{folder}/in")
        run(incremental.arriving(spark, f"{folder}/in", rows.schema), folder)
    return folder


@query("stream_resume", "SELECT event_id, user_id, event_type FROM events WHERE value > 10")
def stream_resume(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")

    def run(stream, folder):
        incremental.append_new(stream.filter("value > 10").drop("value"), f"{folder}/out",
                               f"{folder}/check")

    folder = _in_slices(spark, events, "event_id", run)
    return spark.read.schema("event_id bigint, user_id bigint, event_type string").parquet(
        f"{folder}/out")


def _deduplicated(spark, rows, keys, order):
    """Land ``rows`` in slices of event ids; the rows written by all runs together."""
    stores = []

    def run(stream, folder):
        stores.append(f"{folder}/seen")
        seen.append_unseen(stream, keys, order, f"{folder}/out", stores[-1], f"{folder}/check",
                           buckets=16)

    folder = _in_slices(spark, rows, "event_id", run)
    seen.SeenKeys(spark, stores[-1]).forget_name(spark)
    return seen.written(spark, f"{folder}/out")


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return _deduplicated(spark, events, ["user_id", "event_type"], [F.col("event_id")]).select(
        "user_id", "event_type")


# Slices lie 200 days apart, so that keys come back long after they were seen.
_FAR_SQL = """e AS (SELECT user_id, event_type, event_id, ts + to_days(CAST(200 * (
  (event_id - (SELECT min(event_id) FROM events)) // ((SELECT max(event_id) - min(event_id) FROM events)
  // 3 + 1)) AS INTEGER)) AS ts FROM events)"""


@query("stream_dedup_bounded", f"""WITH {_FAR_SQL}
SELECT user_id, event_type, min(event_id) AS event_id, arg_min(ts, event_id) AS ts
FROM e GROUP BY user_id, event_type""")
def stream_dedup_bounded(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    slice_no = F.floor((F.col("event_id") - low) / ((high - low) // SLICES + 1)).cast("int")
    far = events.withColumn("ts", F.col("ts") + F.make_dt_interval(days=slice_no * 200))
    return _deduplicated(spark, far, ["user_id", "event_type"], [F.col("event_id")])


@query("stream_upsert", """
SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey,
       arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey""")
def stream_upsert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")

    def run(stream, folder):
        incremental.log_changes(stream, f"{folder}/log", f"{folder}/check")

    folder = _in_slices(spark, orders, "o_orderkey", run)
    return incremental.current_rows(spark, f"{folder}/log", "o_custkey",
                                    [F.col("o_orderkey").desc()])


@query("stream_upsert_compacted", """
SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey""")
def stream_upsert_compacted(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")

    def run(stream, folder):
        incremental.log_changes(stream, f"{folder}/log", f"{folder}/check")

    folder = _in_slices(spark, orders, "o_orderkey", run)
    order = [F.col("o_orderkey").desc()]
    incremental.compact(spark, f"{folder}/log", "o_custkey", order, f"{folder}/small")
    return incremental.current_rows(spark, f"{folder}/small", "o_custkey", order)


@query("stream_counter", """
SELECT event_id, CAST(ts + INTERVAL 7 HOUR AS DATE) AS day,
       row_number() OVER (PARTITION BY CAST(ts + INTERVAL 7 HOUR AS DATE) ORDER BY event_id) AS counter
FROM events""")
def stream_counter(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    day = F.to_date(F.col("ts") + F.make_dt_interval(hours=F.lit(7)))

    def run(stream, folder):
        incremental.counters(stream, f"{folder}/out", f"{folder}/check", day, [F.col("event_id")])

    folder = _in_slices(spark, events, "event_id", run)
    return spark.read.parquet(f"{folder}/out/rows").select("event_id", "day", "counter")


@query("retry_undecided", """
SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (
  SELECT user_id FROM events WHERE event_type = 'purchase' AND event_id % 20 = 0)""")
def retry_undecided(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    done = events.select("user_id", F.when((F.col("event_type") == "purchase") & (
        F.col("event_id") % 20 == 0), True).alias("gone"))
    return incremental.retry_undecided(events.select("user_id").distinct(), done, "user_id", "gone")


@query("rounds_until_quiet", """
SELECT user_id, event_type, min(event_id % 4) AS batch FROM events GROUP BY ALL""")
def rounds_until_quiet(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    folder = scratch.fresh(spark, "rounds")

    def rounds(number):
        return events.filter(F.col("event_id") % 4 == number) if number < 4 else None

    incremental.until_quiet(spark, rounds, ["user_id", "event_type"], [F.col("event_id")], folder,
                            max_quiet=None)
    return spark.read.option("basePath", f"{folder}/rows").parquet(f"{folder}/rows").select(
        "user_id", "event_type", "batch")
