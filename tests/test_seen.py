"""Exact deduplication across runs: keys that return late, repeated batches, restarts, the plan."""

from pyspark.sql import functions as F

from shelfmark import scratch
from shelfmark.streaming import incremental, seen

SCHEMA = "day int, k string, n int"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{folder}/in")


def run(spark, folder, buckets=4):
    stream = incremental.arriving(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema)
    seen.append_unseen(stream, ["k"], [F.col("day"), F.col("n")], f"{folder}/out", f"{folder}/seen",
                       f"{folder}/check", buckets)


def written(spark, folder):
    return sorted((tuple(r) for r in seen.written(spark, f"{folder}/out").collect()), key=str)


def test_a_key_returning_after_200_days_is_written_once(spark):
    folder = scratch.fresh(spark, "seen")
    land(spark, folder, [(1, "a", 2), (1, "a", 1), (1, None, 5), (2, "b", 3)])
    run(spark, folder)
    land(spark, folder, [(201, "a", 0), (201, "c", 1), (201, None, 0)])
    run(spark, folder)
    land(spark, folder, [(401, "c", 0), (401, "b", 0), (401, "", 7)])
    run(spark, folder)
    assert written(spark, folder) == sorted(
        [(1, "a", 1), (1, None, 5), (2, "b", 3), (201, "c", 1), (401, "", 7)], key=str)


def test_a_repeated_batch_changes_nothing(spark):
    store = seen.SeenKeys(spark, scratch.fresh(spark, "seen"), 4)
    first = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], SCHEMA)
    second = spark.createDataFrame([(2, "b", 1), (2, "c", 1)], SCHEMA)
    order = [F.col("n")]
    store.add(store.unseen(first, ["k"], order, 0), 0)
    wanted = store.unseen(second, ["k"], order, 1).select("k").collect()
    store.add(store.unseen(second, ["k"], order, 1), 1)          # the run breaks off here
    assert store.unseen(second, ["k"], order, 1).select("k").collect() == wanted == [("c",)]
    store.add(store.unseen(second, ["k"], order, 1), 1)
    assert store.unseen(second, ["k"], order, 2).count() == 0
    packed = store.compact(spark, scratch.fresh(spark, "seen"))
    assert packed.before(spark, 9).count() == 3
    assert packed.unseen(second, ["k"], order, 2).count() == 0


def test_the_store_outlives_the_catalog(spark):
    folder = scratch.fresh(spark, "seen")
    store = seen.SeenKeys(spark, folder, 8)
    rows = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    store.add(store.unseen(rows, ["k"], [F.col("n")], 0), 0)
    store.forget_name(spark)
    again = seen.SeenKeys(spark, folder)
    assert again.buckets == 8
    assert again.unseen(rows, ["k"], [F.col("n")], 1).count() == 0


def test_keys_of_different_types_and_nulls_differ(spark):
    rows = spark.createDataFrame([("1", None), (None, "1"), ("1", "1"), ("", None)], "a string, b string")
    assert rows.select(seen.SeenKeys.digest(["a", "b"]).alias("k")).distinct().count() == 4


def test_the_store_is_not_shuffled(spark):
    store = seen.SeenKeys(spark, scratch.fresh(spark, "seen"), 8)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("n"))
    store.add(store.unseen(rows, ["k"], [F.col("n")], 0), 0)
    store.add(store.unseen(rows.withColumn("k", F.concat("k", F.lit("x"))), ["k"], [F.col("n")], 1), 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.unseen(rows, ["k"], [F.col("n")], 2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "seen_" in line)
    joins = [i for i, line in enumerate(lines[:scan]) if "LeftSemi" in line]
    assert joins and not any("Exchange" in line for line in lines[joins[-1]:scan]), plan
    assert "Bucketed: true" in lines[scan], plan
