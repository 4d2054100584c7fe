"""Operators on small frames, against plain Python where the rule is sequential."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import dates
from shelfmark.operators import (aggregates, dedup, enrich, numbering, ordered, pairing, ranking,
                                 skew)


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def hot_rows(n=3000, share=3, keys=40, seed=5):
    """One key holds a third of the rows; some keys are null."""
    rng = random.Random(seed)
    return [(i, "hot" if i % share == 0 else rng.choice([None, *map(str, range(keys))]),
             rng.randrange(100)) for i in range(n)]


def test_lookup_keeps_rows_and_finds_all(spark):
    left = spark.createDataFrame(hot_rows(), "id int, k string, v int")
    right = spark.createDataFrame([("hot", 1), ("3", None), ("none", 9)], "k string, x int")
    got = rows(skew.lookup(left, right, ["k"]), "id", "k", "v", "x")
    known = {"hot": 1, "3": None, "none": 9}
    assert got == sorted(((i, k, v, known.get(k)) for i, k, v in hot_rows()), key=repr)


def test_lookup_spreads_hot_and_null_keys(spark, monkeypatch):
    """With broadcasts of the big side off, no task may get the whole hot key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = spark.createDataFrame(hot_rows(), "id int, k string, v int").repartition(4)
        right = spark.createDataFrame([(str(i), i) for i in range(40)], "k string, x int")
        joined = skew.lookup(left, right, ["k"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3000 and max(sizes) < 1200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_lookup_refuses_clashing_columns(spark):
    left = spark.createDataFrame([(1, 2)], "k int, x int")
    with pytest.raises(ValueError):
        skew.lookup(left, left, ["k"])


def test_hot_keys_are_counted_in_groups_of_fixed_number(spark):
    """Millions of keys give a task no more groups than there are hashes; cold keys are not hot ones."""
    keys = spark.range(1 << 22).select(F.col("id").alias("k"))
    hashes = keys.select(skew._hash(["k"], {"k": "bigint"}).alias("h")).distinct()
    assert hashes.count() <= 1 << skew.HASH_BITS
    hot = keys.unionAll(spark.range(1 << 18).select(F.lit(-5).cast("bigint").alias("k")))
    (found,) = skew.hot_hashes(hot, ["k"]).collect()
    of_hot = spark.range(1).select(F.lit(-5).cast("bigint").alias("k")).select(skew._hash(["k"], {"k": "bigint"}))
    assert found["_hash"] == of_hot.first()[0]


def test_members(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    ids = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(skew.members(left, ids, ["k"]), "k") == [("a",)]
    assert rows(skew.members(left, ids, ["k"], keep=False), "k") == [("b",), (None,)]


def test_number_rows_with_hot_and_null_keys(spark):
    data = hot_rows()
    frame = spark.createDataFrame(data, "id int, k string, v int").repartition(7)
    got = rows(ordered.number_rows(frame, [F.col("v"), F.col("id")], ["k"]), "id", "row_no")
    want, seen = [], {}
    for i, k, v in sorted(data, key=lambda r: (r[2], r[0])):
        seen[k] = seen.get(k, 0) + 1
        want.append((i, seen[k]))
    assert got == sorted(want, key=repr)


def test_number_rows_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, k string")
    assert ordered.number_rows(empty, [F.col("id")], ["k"]).count() == 0


def test_running_sum_with_nulls_and_total(spark):
    data = [(i, i % 2, None if i % 5 == 0 else i) for i in range(500)]
    frame = spark.createDataFrame(data, "id int, k int, v int").repartition(5)
    got = rows(ordered.running_sum(frame, "v", [F.col("id")], ["k"], total="t"), "id", "running", "t")
    want = [(i, sum(v or 0 for j, q, v in data if q == k and j <= i),
             sum(v or 0 for _, q, v in data if q == k)) for i, k, _ in data]
    assert got == sorted(want, key=repr)


def test_first_wins_plan_limits_before_the_shuffle(spark):
    frame = spark.createDataFrame(hot_rows(), "id int, k string, v int")
    plan = dedup.first_wins(frame, ["k"], [F.col("id")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_wins_does_not_depend_on_row_order(spark):
    data = hot_rows(600)
    for seed in range(3):
        random.Random(seed).shuffle(data)
        frame = spark.createDataFrame(data, "id int, k string, v int").repartition(3 + seed)
        once = dedup.first_wins(frame, ["k"], [F.col("v").desc(), F.col("id")])
        result = rows(once, "id", "k")
        assert result == rows(dedup.first_wins(once, ["k"], [F.col("id")]), "id", "k")
        assert seed == 0 or result == earlier
        earlier = result


def test_latest_with_count_null_rules(spark):
    frame = spark.createDataFrame([
        ("a", "2025-01-01", 1), ("a", None, 2), ("a", "2025-03-01", 4), ("a", "2025-03-01", 3),
        (None, None, 6), (None, "2024-01-01", 7), ("b", None, 9), ("b", None, 8)],
        "url string, day string, seq int").withColumn("day", F.to_date("day"))
    best = dedup.latest_with_count(frame, "url", F.col("day"), ["seq"])
    assert rows(best, "url", "seq", "review_count") == [
        ("a", 3, 4), ("b", 8, 2), (None, 7, None)]


def prefix_by_hand(items):
    kept, first = [], None
    for seq, item in items:
        if first is None and item:
            first = item
        if kept and item and item == first:
            break
        kept.append(seq)
    return kept


@pytest.mark.parametrize("items", [
    ["a", "b", "a", "c"], [None, "a", "b"], ["a", None, "a"], [None, None], ["a", "a"], ["a", "b"]])
def test_prefix_until_repeat(spark, items):
    data = [("s", i, item) for i, item in enumerate(items)]
    frame = spark.createDataFrame(data, "shop string, seq int, item string")
    got = [r["seq"] for r in dedup.prefix_until_repeat(frame, "shop", "seq", "item")
           .orderBy("seq").collect()]
    assert got == prefix_by_hand(list(enumerate(items)))


def test_later_pass_wins(spark):
    frame = spark.createDataFrame([
        ("a", 1, "x"), ("a", 2, ""), ("a", 3, "y"), ("b", 1, None), ("b", 2, ""), ("", 1, "z"),
        ("c", 1, "x"), ("c", 2, None)], "id string, pass_no int, image string")
    best = dedup.later_pass_wins(frame, "id", "pass_no", F.col("image") != "")
    assert rows(best, "id", "pass_no") == [("a", 3), ("b", 1), ("c", 1)]


def test_longest_wins_tie_keeps_earlier(spark):
    frame = spark.createDataFrame([("a", 2, ["u", "v"]), ("a", 1, ["x", "y"]), ("a", 0, ["z"])],
                                  "id string, file int, urls array<string>")
    assert rows(dedup.longest_wins(frame, ["id"], "urls", [F.col("file")]), "file") == [(1,)]


def test_merge_rows_right_side_wins(spark):
    left = spark.createDataFrame([(1, "a", "l"), (2, "b", None)], "i int, x string, y string")
    right = spark.createDataFrame([(1, None, "z"), (3, "c", "w")], "i int, x string, z string")
    assert rows(enrich.merge_rows(left, right, "i"), "i", "x", "y", "z") == [
        (1, "a", "l", "z"), (2, "b", None, None), (3, "c", None, "w")]
    assert enrich.drop_hollow(spark.createDataFrame(
        [("", None, "u"), ("a", None, None)], "a string, b int, image string"), ["image"]).count() == 1


def test_fill_first_match_touches_the_first_row_only(spark):
    frame = spark.createDataFrame([("a", 1, ""), ("a", 2, ""), ("b", 3, "old"), ("c", 4, "")],
                                  "id string, seq int, image string")
    news = spark.createDataFrame([("a", "n"), ("b", "n"), ("z", "n")], "id string, image string")
    filled = enrich.fill_first_match(frame, news, "id", "image", "seq", F.col("image") == "")
    assert rows(filled, "seq", "image", "state") == [
        (1, "n", "updated"), (2, "", "untouched"), (3, "old", "skipped"), (4, "", "untouched")]
    assert rows(enrich.update_counts(filled, news, "id"), "updated", "skipped", "notfound") == [
        (1, 1, 1)]


def test_match_any_takes_first_target(spark):
    wanted = spark.createDataFrame([(1, "s", "T"), (2, "s", "U"), (3, "o", "T")],
                                   "n int, shop string, title string")
    cards = spark.createDataFrame([("s", 5, "T", "x"), ("s", 3, "y", "T"), ("s", 4, None, "")],
                                  "shop string, pos int, a string, b string")
    got = enrich.match_any(wanted, cards.withColumn("card", F.col("pos")), ["shop"], "title",
                           [F.col("a"), F.col("b")], "pos", ["card"])
    assert rows(got, "n", "card", "matched") == [(1, 3, True), (2, None, False), (3, None, False)]


def pair_by_hand(fronts, backs):
    last = {k: n for n, k in sorted(backs)}
    pairs = [(n, last[k]) for n, k in sorted(fronts) if k in last]
    alone = [n for n, k in sorted(fronts) if k not in last]
    spare = [n for n, _ in sorted(backs) if n not in {b for _, b in pairs}]
    return sorted(pairs + list(zip(alone, spare)))


@pytest.mark.parametrize("seed", range(3))
def test_pair(spark, seed):
    rng = random.Random(seed)
    fronts = [(f"f{i:02}", str(rng.randrange(8))) for i in range(12)]
    backs = [(f"b{i:02}", str(rng.randrange(12))) for i in range(9)]
    frames = [spark.createDataFrame(x, "name string, key string") for x in (fronts, backs)]
    assert rows(pairing.pair(*frames, "key", "name"), "front", "back") == pair_by_hand(fronts, backs)


def test_exact_median(spark):
    data = [(i % 3, float((i * 37) % 101)) for i in range(400)] + [(9, 1.0)]
    frame = spark.createDataFrame(data, "k int, v double")
    got = rows(aggregates.exact_median(frame, "k", "v", 2), "k", "n", "median")
    want = [(k, len(v), statistics.median(v)) for k in range(3)
            for v in [[x for q, x in data if q == k]]]
    assert got == want


def test_robust_tilt_needs_enough_segments(spark):
    flat = [("a", 0.0, 0.0, 10.0, 1.0)] * 5
    few = [("b", 0.0, 0.0, 10.0, 1.0)] * 4 + [("b", 3.0, 0.0, 3.0, 9.0)]
    steep = [("c", 0.0, 0.0, 1.0, 9.0)] * 9
    fold = [("d", 0.0, 0.0, 10.0, 14.0)] * 5
    frame = spark.createDataFrame(flat + few + steep + fold,
                                  "k string, x1 double, y1 double, x2 double, y2 double")
    got = rows(aggregates.robust_tilt(frame, "k", "x1", "y1", "x2", "y2"), "k", "tilt")
    assert got == [("a", 5.7), ("d", -35.5)]


def test_status_counts_without_done_rows(spark):
    frame = spark.createDataFrame([("failed", 3.0)], "s string, e double")
    assert rows(aggregates.status_counts(frame, "s", "e"), "done", "failed", "mean_elapsed") == [
        (0, 1, 0.0)]


def test_top_k_is_exact_above_the_usual_limit(spark):
    frame = spark.range(20000).repartition(6)
    got = [r["id"] for r in ranking.top_k(frame, [F.col("id").desc()], 1500).orderBy("rank").collect()]
    assert got == list(range(19999, 18499, -1))
    plan = ranking.top_k(frame, [F.col("id").desc()], 1500)._jdf.queryExecution().toString()
    assert "GlobalLimit" in plan or "TakeOrdered" in plan
    assert spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold") == "1000"


def walk_by_hand(data, rankings, per_ranking, page_rows, max_rows):
    seen = {}
    for number, (column, direction) in enumerate(rankings):
        sign = -1 if direction == "desc" else 1
        ranked = sorted(data, key=lambda r: (sign * r[column], r["k"]))[:per_ranking]
        for start in range(0, len(ranked), page_rows):
            if len(seen) >= max_rows:
                return seen
            for r in ranked[start:start + page_rows]:
                seen.setdefault(r["k"], number)
    return seen


@pytest.mark.parametrize("max_rows", [25, 60, 10000])
def test_union_of_rankings(spark, max_rows):
    rng = random.Random(1)
    data = [{"k": i, "a": rng.randrange(50), "b": rng.randrange(50)} for i in range(300)]
    rankings = [("a", "desc"), ("b", "asc"), ("a", "desc"), ("a", "asc")]
    got = ranking.union_of_rankings(spark.createDataFrame(data, "k int, a int, b int"), "k", rankings,
                                    35, 10, max_rows)
    assert dict(rows(got, "k", "ranking")) == walk_by_hand(data, rankings, 35, 10, max_rows)


def test_pages_and_batches(spark):
    frame = spark.range(95).repartition(3)
    paged = ranking.pages(frame, [F.col("id")], 20)
    assert rows(paged.groupBy("page").count(), "page", "count") == [
        (1, 20), (2, 20), (3, 20), (4, 20), (5, 15)]
    batched = ranking.batches(frame, [F.col("id")])
    assert rows(batched.groupBy("batch").count(), "batch", "count") == [(0, 40), (1, 40), (2, 15)]
    assert ranking.rows_from(frame, [F.col("id")], 90).count() == 5


def test_resume_point_stops_at_first_gap(spark):
    shops = spark.createDataFrame([(1, 5, 5), (2, 4, 4), (3, 6, 2), (4, 3, 3), (5, 9, 0)],
                                  "pos int, total int, uploaded int")
    offsets = numbering.shop_offsets(shops, [F.col("pos")], "total", "uploaded")
    assert rows(offsets, "pos", "start", "resume_row") == [
        (1, 0, 6), (2, 5, 10), (3, 9, 12), (4, 15, 19), (5, 18, 19)]
    assert numbering.resume_point(offsets, "total", "uploaded").first()[0] == 11


@pytest.mark.parametrize("name, want", [
    ("[NTD050626A256] x", 257), ("NTD050626A09", 10), ("[NTD040626A256] x", 1), ("odd", 1)])
def test_next_counter(spark, name, want):
    cards = spark.createDataFrame([(name, 2), ("[NTD050626A01] y", 1)], "name string, pos int")
    assert numbering.next_counter(cards, "name", ["pos"], F.lit("050626")).first()[0] == want


def test_next_counter_of_an_empty_board(spark):
    cards = spark.createDataFrame([], "name string, pos int")
    assert numbering.next_counter(cards, "name", ["pos"], F.lit("050626")).first()[0] == 1


def test_day_number_above_ninety_nine(spark):
    frame = spark.range(120).select("id", F.lit("2026-06-05 01:00:00").cast("timestamp_ntz").alias("t"))
    named = numbering.number_per_day(frame, dates.board_time(F.col("t")), [F.col("id")], F.lit("T"))
    got = {r["id"]: r["expected_name"] for r in named.collect()}
    assert got[0] == "[NTD050626A01] T" and got[119] == "[NTD050626A120] T"


def test_first_items_cut_and_order(spark):
    frame = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").cast("string").alias("v"),
                                    "id")
    got = {r["k"]: r["items"] for r in aggregates.first_items(frame, "k", "v", [F.col("id")], 3)
           .collect()}
    assert got == {0: ["0", "2", "4"], 1: ["1", "3", "5"]}
