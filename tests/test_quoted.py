"""Multi-line CSV read in splits: equal to a reader that takes each file whole."""

import csv
import random

import pytest

from shelfmark.sources import quoted

SMALL = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def made(seed, count):
    draw = random.Random(seed)
    pieces = ["a", "b c", "\n", "\n\n", '"', ",", "é", "x" * 60, "", '""', "\r\n"]
    return [[str(i), *("".join(draw.choice(pieces) for _ in range(draw.randint(0, 6))).strip(" ")
                       for _ in range(2))] for i in range(count)]


def write(path, rows, end="\n", mark=""):
    with open(path, "w", encoding="utf-8", newline="") as handle:
        handle.write(mark)
        csv.writer(handle, lineterminator=end).writerows([["n", "one", "two"], *rows])


def plain(rows):
    return sorted(tuple(v if v.strip() else None for v in row) for row in rows)


@pytest.mark.parametrize("end, mark", [("\n", ""), ("\r\n", "﻿")])
def test_rows_equal_a_whole_read_over_many_splits(spark, tmp_path, small_splits, end, mark):
    rows = made(1, 150)
    write(f"{tmp_path}/r.csv", rows, end, mark)
    frame = quoted.read_quoted_csv(spark, str(tmp_path), ["n", "one", "two"])
    assert quoted._lines(spark, str(tmp_path)).select("_block").distinct().count() > 5
    got = [tuple(r) for r in frame.select("n", "one", "two").collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_several_files_keep_their_order(spark, tmp_path, small_splits):
    one, two = made(2, 40), made(3, 40)
    write(f"{tmp_path}/a.csv", one)
    write(f"{tmp_path}/b.csv", two)
    frame = quoted.read_quoted_csv(spark, str(tmp_path), ["n", "one", "two"])
    got = [(r["source_file"], r["n"]) for r in frame.orderBy("arrival").collect()]
    assert got == [("a.csv", r[0]) for r in one] + [("b.csv", r[0]) for r in two]


def test_one_line_records_are_not_gathered(spark, tmp_path):
    write(f"{tmp_path}/r.csv", [["1", "a", "b"], ["2", 'q"q', "c"]])
    lines = quoted._lines(spark, str(tmp_path))
    assert lines.where("_odd or _inside").count() == 0


def test_empty_file_and_unclosed_quote(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "u.csv").write_text('n,one,two\n1,a,b\n2,"open,c\n3,d,e\n')
    got = quoted.records(spark, str(tmp_path)).orderBy("arrival").collect()
    assert [r["record"] for r in got] == ["n,one,two", "1,a,b", '2,"open,c\n3,d,e']
