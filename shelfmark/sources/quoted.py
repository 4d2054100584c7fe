"""CSV with line breaks inside quotes, read in splits.

Spark's own reader takes such a file in one task, for only a count of all quotes before a line says
whether the line begins a record. Here the file is read as lines, in as many splits as it has. Every
split counts its quotes, and the records that would begin in it if it began outside or inside quotes;
a prefix sum over the splits of a file, one row each, then says which it was and how many records
came before. Lines that are a record of their own, nearly all, are parsed where they are; only the
lines of broken records are brought together.

Quotes inside a field are doubled. A quote that is never closed takes the rest of its file into one
record, as it does for any reader of the format.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import text

_SPLIT = ["_file", "_block"]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their split, their order in it, their quotes, and the quotes before them in it."""
    raw = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    before = Window.partitionBy(*_SPLIT).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return raw.withColumn("_odd", quotes % 2 == 1).withColumn("_inside", F.coalesce(
        F.sum(F.col("_odd").cast("int")).over(before), F.lit(0)) % 2 == 1)


def _splits(lines: DataFrame) -> DataFrame:
    """Per split: whether it begins inside quotes, and the records begun before it in its file."""
    counted = lines.groupBy(*_SPLIT).agg(
        (F.sum(F.col("_odd").cast("int")) % 2).alias("_flips"),
        F.count_if(~F.col("_inside")).alias("_outside_starts"),
        F.count_if(F.col("_inside")).alias("_inside_starts"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    opened = counted.withColumn("_opened", F.coalesce(
        F.sum("_flips").over(earlier), F.lit(0)) % 2 == 1)
    starts = F.when(F.col("_opened"), F.col("_inside_starts")).otherwise(F.col("_outside_starts"))
    return opened.withColumn("_starts", starts).select(
        *_SPLIT, "_opened", F.coalesce(F.sum("_starts").over(earlier), F.lit(0)).alias("_earlier"))


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(record, number from 1 in its file, source_file, arrival): the text of every record.

    arrival is (file, block, row) of the record's first line. Empty lines between records are no
    records but keep their number.
    """
    lines = _lines(spark, path)
    so_far = Window.partitionBy(*_SPLIT).orderBy("_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = lines.join(_splits(lines), _SPLIT).withColumn(
        "_begins", F.col("_inside") == F.col("_opened"))
    placed = placed.withColumn("number", F.col("_earlier") + F.sum(
        F.col("_begins").cast("int")).over(so_far))
    arrival = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"),
                       F.col("_row").alias("row"))
    alone = F.col("_begins") & ~F.col("_odd")
    whole = placed.where(alone).select(F.col("value").alias("record"), "number", "source_file",
                                       arrival.alias("arrival"))
    parts = F.sort_array(F.collect_list(F.struct(arrival.alias("arrival"), "value")))
    broken = (placed.where(~alone).groupBy("_file", "number", "source_file")
              .agg(parts.alias("_parts")).select(
        F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("record"), "number",
        "source_file", F.get("_parts", F.lit(0))["arrival"].alias("arrival")))
    return whole.unionByName(broken).withColumn(
        "record", F.regexp_replace("record", "^﻿|\r$", "")).where("record <> ''")


def read_quoted_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str],
                    header: bool = True, delimiter: str = ",") -> DataFrame:
    """As ``files.read_csv`` with ``multiline``, but one file is read by many tasks. The header is the
    first line of a file."""
    rows = records(spark, path)
    if header:
        rows = rows.where("number > 1")
    fields = F.from_csv("record", ", ".join(f"`{c}` string" for c in columns), {
        "sep": delimiter, "quote": '"', "escape": '"', "multiLine": "true"})
    return text.nulls_for_blanks(rows.select(fields.alias("_fields"), "source_file", "arrival").select(
        "_fields.*", "source_file", "arrival"), columns)
