"""Keyword containment through the q-gram index against plain loops."""

import random

from pyspark.sql import functions as F

from shelfmark.operators import containment


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def frames(spark, texts, words):
    return (spark.createDataFrame(list(enumerate(texts)), "id int, t string"),
            spark.createDataFrame([(w,) for w in words], "keyword string"))


def test_equals_plain_loops(spark):
    draw = random.Random(1)
    texts = ["".join(draw.choice("abcé🔑 ") for _ in range(draw.randint(0, 40))) for _ in range(120)]
    texts += [None, "", "a", "hot hot hot " * 500, *["the same text"] * 5]
    words = {"".join(draw.choice("abcé🔑 ") for _ in range(draw.randint(1, 7))) for _ in range(400)}
    words |= {"hot", "same text", "zzzz", "hot hot hot hot"}
    left, right = frames(spark, texts, [*words, None, "", "hot"])
    want = sorted(((i, w) for i, t in enumerate(texts) for w in words if w in (t or "")), key=str)
    assert rows(containment.contains_any_of(left, "id", "t", right), "id", "keyword") == want


def test_no_short_keywords_and_no_keywords(spark):
    left, right = frames(spark, ["keyboard", "key"], ["keyb", "board", "boards"])
    assert rows(containment.contains_any_of(left, "id", "t", right), "id", "keyword") == [
        (0, "board"), (0, "keyb")]
    assert containment.contains_any_of(left, "id", "t", right.where("false")).count() == 0


def test_ten_thousand_keywords_without_a_nested_loop(spark):
    left, _ = frames(spark, [f"text with word{i} in it" for i in range(0, 3000, 7)], [])
    right = spark.range(10_000).select(F.concat(F.lit("word"), F.col("id").cast("string")).alias("keyword"))
    found = containment.contains_any_of(left, "id", "t", right)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = sum(len({f"word{i}"[:n] for n in range(5, len(f"word{i}") + 1)}) for i in range(0, 3000, 7))
    assert found.count() == want


def test_labels_from_a_table(spark):
    texts = spark.createDataFrame([(1, "A CAT and a dog"), (2, "a dog in a boat"), (3, "none"), (4, None)],
                                  "id int, t string")
    taxonomy = spark.createDataFrame([
        ("pets", None, 1, "Cat"), ("dogs", None, 2, "dog"), ("kittens", "pets", 3, "cat"),
        ("sailing", "dogs", 5, "boat"), ("hounds", "dogs", 4, "dog"), ("empty", None, 0, "")],
        "label string, parent string, ord int, keyword string")
    got = containment.table_labels(texts, "id", "t", taxonomy)
    assert rows(got, "id", "niche", "sub_niche") == [
        (1, "pets", "kittens"), (2, "dogs", "hounds"), (3, None, None), (4, None, None)]


def test_heads_of_all_lengths_equal_plain_loops(spark):
    draw = random.Random(2)
    texts = ["".join(draw.choice("abé🔑") for _ in range(draw.choice([0, 15, 16, 31, 33, 200]))) for _ in range(60)]
    piece = containment._CHARS  # keywords across the pieces of a long text
    texts += ["".join(draw.choice("cdé") for _ in range(2 * piece + 70))]
    words = {texts[-1][at - n // 2:][:n] for at in (piece, 2 * piece) for n in (9, 15, 16, 40, 64, 127)}
    words |= {t[i:i + n] for t in texts[:20] for n in (1, 2, 5, 15, 16, 17, 31, 32, 33, 63, 64, 90)
             for i in (0, 7, len(t) - n) if 0 <= i <= len(t) - n}
    words |= {w[:-1] + "x" for w in words} | {a[-9:] + b[:9] for a, b in zip(texts, texts[1:])} - {""}
    left, right = frames(spark, texts, words)
    want = sorted(((i, w) for i, t in enumerate(texts) for w in words if w in t), key=str)
    assert rows(containment.contains_any_of(left, "id", "t", right), "id", "keyword") == want


def test_texts_are_neither_shuffled_nor_searched(spark):
    left, right = frames(spark, ["a long text with a keyword"], ["keyword", "long", "with"])
    found = containment.contains_any_of(left, "id", "t", right)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" not in plan and "regexp" not in plan and plan.count("Join") == 1
    assert found.count() == 3
