"""Readers for text, CSV, JSON and folders of files.

Every text reader adds an ``arrival`` struct (file, block, row), the order in which a one-file-
after-the-other read would have met the rows. It is what "first" and "last" refer to later on;
partition order is never relied on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import scratch, values
from ..functions import text, urls
from ..operators import dedup
from ..operators.ordered import number_rows
from ..operators.skew import lookup, members


def _with_arrival(df: DataFrame) -> DataFrame:
    """Add arrival, whose file is the whole path (names may repeat), and the name as a label."""
    return df.select("*", F.col("_metadata.file_name").alias("source_file"), F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")).alias("arrival"))


def read_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str],
             multiline: bool = False, header: bool = True, delimiter: str = ",") -> DataFrame:
    """CSV with every column a string, blanks as null, the file name and the arrival.

    ``multiline`` allows line breaks inside quotes; such a file cannot be split, so keep these
    files moderate in size. A byte-order mark is dropped.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = (spark.read.schema(schema).option("header", header).option("multiLine", multiline)
           .option("quote", '"').option("escape", '"').option("sep", delimiter)
           .option("enforceSchema", not header).csv(path))
    return text.nulls_for_blanks(_with_arrival(raw), columns)


def read_csv_drifted(spark: SparkSession, groups: Sequence[tuple[str, Sequence[str]]],
                     **options) -> DataFrame:
    """Union of CSV groups with different columns; absent columns become null."""
    frames = [read_csv(spark, path, columns, **options) for path, columns in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with declared types, read as parallel splits."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_url_lines(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    """Ragged lines ``id-or-listing-url,url,url,...`` -> listing_id, urls, arrival.

    URLs may hold commas themselves, so they are found by ``pattern`` and not by splitting.
    Lines without a numeric id (headers, broken lines) or without a URL are dropped.
    """
    lines = _with_arrival(spark.read.text(path)).withColumn(
        "line", text.strip(F.regexp_replace("value", "^﻿", "")))
    lines = lines.filter(F.instr("line", ",") > 0)
    first = text.strip(F.substring_index("line", ",", 1))
    rest = F.substring(F.col("line"), F.instr("line", ",") + 1, F.length("line"))
    return lines.select(
        F.coalesce(urls.listing_id(first), first).alias("listing_id"),
        text.distinct_urls(F.regexp_extract_all(rest, F.lit(pattern), F.lit(0))).alias("urls"),
        "arrival", F.col("_metadata.file_modification_time").alias("file_time"),
    ).filter(F.col("listing_id").rlike(r"^\d+$") & (F.size("urls") > 0))


def merge_url_lines(lines: DataFrame) -> DataFrame:
    """Best file per listing: most distinct URLs, earlier file on a tie -> long rows.

    Within a file the lists of one listing are united. The result is (listing_id, position,
    url): a listing may own any number of URLs.
    """
    items = lines.select("listing_id", F.col("arrival.file").alias("file"), "file_time",
                         "arrival", F.posexplode("urls").alias("place", "url"))
    distinct = scratch.settle(items.groupBy("listing_id", "file", "file_time", "url").agg(
        F.min(F.struct("arrival", "place")).alias("at")))
    sizes = distinct.groupBy("listing_id", "file", "file_time").agg(
        F.count(F.lit(1)).alias("n"))
    best = dedup.first_wins(sizes, ["listing_id"], [
        F.col("n").desc(), F.col("file_time"), F.col("file")]).select("listing_id", "file")
    kept = members(distinct, best, ["listing_id", "file"])
    return number_rows(kept, [F.col("at")], ["listing_id"], "position").select(
        "listing_id", "position", "url")


# Bytes 0x80 to 0x9f of Windows code page 1252, and the five bytes it leaves undefined.
_CP1252_BYTES = "".join(chr(b) for b in range(0x80, 0xA0) if b not in (
    0x81, 0x8D, 0x8F, 0x90, 0x9D))
_CP1252_TEXT = bytes(map(ord, _CP1252_BYTES)).decode("cp1252")
_CP1252_HOLES = "[\x81\x8d\x8f\x90\x9d]"


def read_csv_any_encoding(spark: SparkSession, path: str, columns: Sequence[str],
                          multiline: bool = False, delimiter: str = ",") -> DataFrame:
    """CSV files of unknown encoding: UTF-8 (with or without mark), else cp1252, else Latin-1.

    ``columns`` are in file order. Every byte is first read as one Latin-1 character, which
    loses nothing and keeps files splittable; then the first encoding that fits all of a file
    decodes its texts. A file that holds much of the data is looked up as a hot key.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = _with_arrival(
        spark.read.schema(schema).option("header", True).option("multiLine", multiline)
        .option("quote", '"').option("escape", '"').option("sep", delimiter)
        .option("encoding", "iso-8859-1").csv(path)
    ).withColumn("_file", F.col("arrival.file"))

    def as_bytes(name: str) -> Column:
        return F.encode(F.coalesce(F.col(name), F.lit("")), "iso-8859-1")

    def holds(test) -> Column:
        return reduce(lambda a, b: a & b, [test(c) for c in columns])

    fits = raw.groupBy("_file").agg(
        F.bool_and(holds(lambda c: F.is_valid_utf8(as_bytes(c).cast("string")))).alias("_utf8"),
        F.bool_and(holds(lambda c: ~F.coalesce(F.col(c), F.lit("")).rlike(_CP1252_HOLES)))
        .alias("_cp1252"))
    told = lookup(raw, fits, ["_file"])
    decoded = told.select("source_file", "arrival", *[
        F.when(F.col(c).isNull(), None)
        .when(F.col("_utf8"), F.decode(as_bytes(c), "utf-8"))
        .when(F.col("_cp1252"), F.translate(c, _CP1252_BYTES, _CP1252_TEXT))
        .otherwise(F.col(c)).alias(c) for c in columns])
    return text.nulls_for_blanks(decoded, columns)


def read_id_list(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Ids of JSON arrays, one row each: an array per line, or one spread over a whole file."""
    documents = spark.read.text(path, wholetext=whole_file)
    return documents.select(F.explode(F.from_json("value", "array<string>")).alias("listing_id"))


def read_id_map(spark: SparkSession, path: str, key: str = "listing_id",
                value: str = "card_id", whole_file: bool = False) -> DataFrame:
    """Entries of JSON objects, one row each: an object per line or per file."""
    documents = spark.read.text(path, wholetext=whole_file)
    return documents.select(
        F.explode(F.from_json("value", "map<string,string>")).alias(key, value))


def file_paths(spark: SparkSession, root: str) -> DataFrame:
    """Paths of all files below a folder; the contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
            .select("path"))


def images_of_paths(files: DataFrame) -> DataFrame:
    """Image paths root/shop/listing/file -> shop, listing, position, path.

    Positions follow the number in the file name, then the path.
    """
    parts = F.split("path", "/")
    ending = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    rows = files.filter(ending.isin(*values.IMAGE_EXTENSIONS)).select(
        F.element_at(parts, -3).alias("shop_name"), F.element_at(parts, -2).alias("listing_id"),
        "path", urls.number_in(F.col("path")).alias("_number"))
    return number_rows(rows, [F.col("_number"), F.col("path")], ["shop_name", "listing_id"],
                       "position").drop("_number")


def art_of_paths(files: DataFrame) -> DataFrame:
    """Paths of ``{id}_art`` and ``{id}_art_back`` files -> listing_id, front, back.

    Listings without a front are dropped; of several files for one side the last in name order
    counts.
    """
    files = files.filter(
        F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(*values.MIME_TYPES))
    stem = urls.stem(F.col("path"))
    back = urls.id_before(stem, "_art_back")
    front = F.when(back.isNull(), urls.id_before(stem, "_art"))
    sides = files.select("path", front.alias("_front"), back.alias("_back")).withColumn(
        "listing_id", F.coalesce("_front", "_back")).filter(F.col("listing_id").isNotNull())
    return sides.groupBy("listing_id").agg(
        F.max(F.when(F.col("_front").isNotNull(), F.col("path"))).alias("front"),
        F.max(F.when(F.col("_back").isNotNull(), F.col("path"))).alias("back"),
    ).filter(F.col("front").isNotNull())


def scan_images(spark: SparkSession, root: str) -> DataFrame:
    return images_of_paths(file_paths(spark, root))


def scan_art(spark: SparkSession, root: str) -> DataFrame:
    return art_of_paths(file_paths(spark, root))
