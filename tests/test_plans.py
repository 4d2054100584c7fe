"""Plans against a plain walk over the rows, and incremental runs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark import scratch
from shelfmark.plans import artwork, board, inactive
from shelfmark.streaming import incremental


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


LISTING = "shop_name string, listing_id string, title string, tags string, n_images int, seq int"
CARD = "list_name string, id string, name string, desc string, attachment_count int, pos int"


def board_by_hand(listings, cards, counter):
    """The run as a loop: one listing after the other, shop after shop."""
    shops, result = [], {}
    for shop, *_ in listings:
        if shop not in shops:
            shops.append(shop)
    state = {}
    for shop, _, name, desc, count, _ in cards:
        state.setdefault(shop, {}).setdefault(name, (desc or "", count))
    for shop in shops:
        existing = state.setdefault(shop, {})
        for s, lid, title, tags, n_images, _ in listings:
            if s != shop:
                continue
            title, desc = title or lid, (tags or "").strip()
            found = None
            for name, card in existing.items():
                m = re.match(r"^\[.*?\]\s*(.+)", name, re.DOTALL)
                if (m.group(1).strip() if m else "") == title or name == title:
                    found = card
                    break
            if found is None:
                result[lid] = ("create", counter, False)
                existing[f"[NTD{counter}] {title}"] = (desc, 0)
                counter += 1
                continue
            old, count = found
            marked = any(x in old for x in ("**Title:**", "**Tags:**", "**Etsy URL:**"))
            update = marked or old != desc
            if count >= n_images:
                result[lid] = ("skip", counter, update)
            else:
                result[lid] = ("reattach", counter, update)
                counter += 1
    return result


@pytest.mark.parametrize("seed", range(4))
def test_upload_plan_equals_the_walk(spark, seed):
    rng = random.Random(seed)
    titles = ["T1", "T2", "T3", "", None]
    listings = [(rng.choice("AB"), str(i), rng.choice(titles), rng.choice(["x", "y", None]),
                 rng.randrange(3), i) for i in range(25)]
    cards = []
    for i in range(8):
        name = rng.choice(["[NTD1] T1", "T2", "[NTD2] T3", "other", "T1"]) + (" " * 0)
        shop = rng.choice("AB")
        if (shop, name) not in {(c[0], c[2]) for c in cards}:
            cards.append((shop, f"c{i}", name, rng.choice(["x", "**Tags:** x", None]),
                          rng.randrange(3), i))
    plan = board.upload_plan(spark.createDataFrame(listings, LISTING), spark.createDataFrame(cards, CARD), 7)
    got = {r["listing_id"]: (r["action"], r["counter"], r["update_desc"]) for r in plan.collect()}
    assert got == board_by_hand(listings, cards, 7)


def test_plan_of_an_uploaded_board_skips_everything(spark):
    listings = spark.createDataFrame([("A", "1", "T1", "x", 2, 1), ("A", "2", "T2", "y", 1, 2)], LISTING)
    cards = spark.createDataFrame([("A", "c1", "[NTD1] T1", "x", 2, 1), ("A", "c2", "T2", "y", 9, 2)], CARD)
    got = board.upload_plan(listings, cards)
    assert rows(got, "action", "update_desc", "counter") == [("skip", False, 1), ("skip", False, 1)]


def test_renumber_plan_emits_changes_only(spark):
    time = "2026-06-05T0{}:00:00.000Z".format
    cards = spark.createDataFrame([
        ("a", time(1), "[NTD050626A01] One"), ("b", time(3), "Three"), ("c", time(2), "[OLD] Two"),
        ("d", "2026-06-05T18:00:00.000Z", "Next day")], "id string, action_time string, name string")
    plan = board.renumber_plan(cards, board.card_times(cards))
    assert rows(plan, "id", "expected_name") == [
        ("b", "[NTD050626A03] Three"), ("c", "[NTD050626A02] Two"), ("d", "[NTD060626A01] Next day")]


def test_audit_outcomes(spark):
    sku = "NTD050626A01"
    cards = spark.createDataFrame([
        (1, "Mug", "x"), (2, f"[{sku}] Mug", "x"), (3, sku, "**Title:** Mug\n\n**Tags:** a;b"),
        (4, f"[{sku}] Mug", "**Title:** Mug"), (5, f"[{sku}] Cup", " "), (6, f"[{sku}] Pot", None)],
        "n int, name string, desc string")
    plain = {r["n"]: (r["outcome"], r["new_name"], r["new_desc"]) for r in board.name_audit(cards).collect()}
    assert plain == {1: ("no_sku", None, None), 2: ("no_title", None, None),
                     3: ("name,desc", f"[{sku}] Mug", "a, b"), 4: ("desc", None, ""),
                     5: ("no_title", None, None), 6: ("no_title", None, None)}
    source = spark.createDataFrame([("Cup ", "old", 1), ("Cup", "c; d", 2), ("Pot", "", 3)],
                                   "title string, tags string, seq int")
    filled = {r["n"]: (r["outcome"], r["new_desc"]) for r in board.name_audit(
        cards, board.tags_by_title(source, "seq")).collect()}
    assert filled[5] == ("added_from_csv", "c, d") and filled[6] == ("no_title", None)
    assert filled[3] == ("name,desc", "a, b")


def test_inactive_items(spark):
    reviews = spark.createDataFrame([
        ("h/listing/1", "A on Jan 1, 2026", "t1", "i1", 1), ("h/listing/1", "B on Feb 1, 2026", "t2", "i2", 2),
        ("h/listing/2", "C on April 1, 2026", "t3", "i3", 3), ("h/listing/3", "bad", "t4", "i4", 4),
        (None, "D on Jan 1, 2025", "t5", "i5", 5)],
        "url string, data string, title string, image string, seq int")
    latest = inactive.latest_reviews(reviews, ["seq"])
    got = inactive.hidden_table(latest, "2026-03-03", "S")
    assert rows(got, "listing_id", "title", "review_count", "last_review_date") == [
        ("1", "t2", 2, "2026-02-01"), (None, "t5", None, "2025-01-01")]
    counts = inactive.activity_counts(latest, F.col("review_day"), "2026-03-03")
    assert rows(counts, "total", "hidden", "active") == [(4, 2, 2)]


def test_extraction_work_options(spark):
    raw = spark.createDataFrame([("1", "5", "6", "7", "8", "2"), ("2", "", "x", "7", "8", "9"),
                                 ("3", "1", "1", "0", "8", "1"), ("4", "1", "1", "2", "2", "1")],
                                "listing_id string, x string, y string, w string, h string, image string")
    coords = artwork.crop_coordinates(raw)
    assert rows(coords, "listing_id", "x", "y", "image", "has_back") == [
        ("1", 5, 6, 2, False), ("2", 0, 0, 9, False), ("4", 1, 1, 1, False)]
    coords = coords.withColumn("has_back", F.col("listing_id") != "2")
    images = spark.createDataFrame([("1", ["a", "b"]), ("2", ["c"])], "listing_id string, images array<string>")
    none = spark.createDataFrame([], "listing_id string, side string")
    work = artwork.extraction_work(coords, images, none)
    assert rows(work, "listing_id", "image_url", "image_col", "back_image_url") == [
        ("1", "b", "image_2", "a"), ("2", "c", "image_1", None)]
    done = spark.createDataFrame([("1", "back"), ("2", "front")], "listing_id string, side string")
    assert rows(artwork.extraction_work(coords, images, done), "listing_id", "back_skip_done") == [("1", True)]
    assert artwork.extraction_work(coords, images, done, back_only=True).count() == 0
    assert artwork.extraction_work(coords, images, done, skip_done=False).count() == 2


@pytest.mark.parametrize("mode, sides, want", [
    ("auto", True, ["sides", "single"]), ("sides", True, ["sides", "single"]),
    ("sides", False, ["single", "single"]), ("single", True, ["single", "single"])])
def test_compose_modes(spark, mode, sides, want):
    arts = spark.createDataFrame([(True,), (False,)], "has_back boolean")
    got = arts.select(artwork.compose_mode(mode, F.col("has_back"), sides)).collect()
    assert [r[0] for r in got] == want


def test_outputs_by_listing(spark):
    files = spark.createDataFrame([("o/9_b_single.png",), ("o/9_a_single.jpg",), ("o/9_a_sides.jpg",),
                                   ("o/x_single.png",), ("o/3_single.gif",), ("o/4_a_single.png",)], "path string")
    source = spark.createDataFrame([("9", "old", "t", 1), ("9", "new", "u", 5)],
                                   "listing_id string, title string, tags string, pos int")
    got = artwork.outputs_by_listing(files, source, "S", 20).collect()
    assert [(r["listing_id"], r["title"], r["items"]) for r in got] == [
        ("9", "new", ["o/9_a_single.jpg", "o/9_b_single.png"]), ("4", None, ["o/4_a_single.png"])]


def test_next_pass_and_merge(spark):
    listings = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "listing_id string, title string")
    last = spark.createDataFrame([("1", "u"), ("2", ""), ("3", None)], "listing_id string, image_1 string")
    assert rows(artwork.next_pass(last, listings), "listing_id") == [("2",), ("3",)]
    passes = last.withColumn("pass_no", F.lit(1)).union(last.filter("listing_id = '2'").select(
        "listing_id", F.lit("v"), F.lit(2)))
    assert rows(artwork.merge_passes(passes), "listing_id", "image_1") == [("1", "u"), ("2", "v"), ("3", None)]


# Incremental runs.

def land(spark, folder, data):
    spark.createDataFrame(data, "k string, n int").write.mode("append").parquet(folder)


def test_repeated_and_broken_off_runs_change_nothing(spark):
    folder = scratch.fresh(spark, "test")
    land(spark, f"{folder}/in", [("a", 1), ("b", 2)])

    def run(check="check"):
        stream = incremental.arriving(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema)
        incremental.counters(stream, f"{folder}/out", f"{folder}/{check}", F.lit("day"), [F.col("n")])
        return rows(spark.read.parquet(f"{folder}/out/rows"), "k", "counter")

    assert run() == [("a", 1), ("b", 2)]
    assert run() == [("a", 1), ("b", 2)]  # nothing new
    land(spark, f"{folder}/in", [("c", 3)])
    assert run() == [("a", 1), ("b", 2), ("c", 3)]
    # A batch that is taken again writes the same folder again.
    stream = incremental.arriving(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema)
    incremental.log_changes(stream, f"{folder}/log", f"{folder}/log_check")
    incremental.log_changes(stream, f"{folder}/log", f"{folder}/log_check_lost")
    assert rows(incremental.current_rows(spark, f"{folder}/log", "k", [F.col("n")]), "k", "n") == [
        ("a", 1), ("b", 2), ("c", 3)]


def test_later_batches_win_in_the_change_log(spark):
    folder = scratch.fresh(spark, "test")
    for number, value in enumerate((9, 1)):
        land(spark, f"{folder}/in", [("a", value), (f"b{number}", 0)])
        stream = incremental.arriving(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema)
        incremental.log_changes(stream, f"{folder}/log", f"{folder}/check")
    assert rows(incremental.current_rows(spark, f"{folder}/log", "k", [F.col("n")]), "k", "n") == [
        ("a", 1), ("b0", 0), ("b1", 0)]


def test_rounds_stop_when_quiet(spark):
    folder = scratch.fresh(spark, "test")
    data = [[("a", 1)], [("a", 2), ("b", 1)], [("b", 5)], [("a", 7)], [("c", 1)]]
    frames = [spark.createDataFrame(d, "k string, n int") for d in data]
    taken = incremental.until_quiet(spark, lambda i: frames[i], ["k"], [F.col("n")], folder, 2)
    assert taken == 4
    assert rows(spark.read.parquet(f"{folder}/rows"), "k", "n") == [("a", 1), ("b", 1)]
    assert rows(spark.read.parquet(f"{folder}/metrics"), "round", "added") == [(0, 1), (1, 1), (2, 0), (3, 0)]


def test_undecided_rows_come_again(spark):
    todo = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    done = spark.createDataFrame([("a", True), ("b", None)], "id string, gone boolean")
    assert rows(incremental.retry_undecided(todo, done, "id", "gone"), "id") == [("b",), ("c",)]


def test_only_beginnings_as_long_as_some_id_are_looked_up(spark):
    files = spark.createDataFrame([(p,) for p in (
        "a/1_2_art.png", "a/1_2_3_4_5.png", "1.png", "_x.png", "b/9_9.png", "b/1_2")], "path string")
    ids = spark.createDataFrame([("1",), ("1_2_3",), ("",), (None,)], "listing_id string")
    found = artwork.id_candidates(files, ids)
    assert found.count() == 6 + 2  # one part of every stem, three of those that have them
    assert rows(artwork.arts_of_ids(files, ids), "path", "listing_id") == sorted([
        ("1.png", "1"), ("_x.png", ""), ("a/1_2_3_4_5.png", "1"), ("a/1_2_art.png", "1"), ("b/1_2", "1")])
    assert artwork.arts_of_ids(files, ids.where("false")).count() == 0
