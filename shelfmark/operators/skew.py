"""Joins that stay balanced when one key holds a large share of the rows.

A key is *hot* when it holds more than ``1 / HOT_SHARE`` of the rows. By counting, no table has more
than ``HOT_SHARE`` hot keys. A hot key is cut into salts in proportion to its share of the rows, its
lookup row is repeated once per salt, and one join on (key, salt) does the rest; rows with a null
key match nothing and are spread as well. Rows are counted by a hash of 20 bits, so that a task counts
2^20 groups at most, however many keys it meets; keys that share a hot one's hash are salted like it.
All that is broadcast is the hash of each hot key and its number of salts, 12 bytes for at most
``HOT_SHARE`` keys: neither keys nor payload. The repeated rows are at most ``SPLITS`` per shuffle partition
and one per hot key, for each key of its hash (one in 2^20 of the lookup table's). Adaptive skew
splitting cannot do this for us when the lookup side is itself an aggregate, because it only splits plain
shuffle stages.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HOT_SHARE = 10_000
SPLITS = 4          # salts of a key that holds as many rows as an even shuffle partition
HASH_BITS = 20


def _hash(keys: Sequence[str], kinds: dict[str, str]) -> Column:
    """Hash of the keys as values of ``kinds``; two keys of equal hash are salted alike, no more."""
    return F.shiftright(F.xxhash64(*[F.col(k).cast(kinds[k]) for k in keys]), 64 - HASH_BITS)


def hot_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_hash, _salts) of keys holding more than 1/HOT_SHARE of the rows: at most HOT_SHARE rows."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.filter(~any_null(keys)).select(_hash(keys, dict(df.dtypes)).alias("_hash")).groupBy(
        "_hash").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total")).scalar()
    salts = F.ceil(F.col("_n") * (parts * SPLITS) / total).cast("bigint")
    return counts.filter(F.col("_n") * HOT_SHARE > total).select("_hash", salts.alias("_salts"))


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])


def _spread(df: DataFrame) -> Column:
    """A salt that differs from row to row, and between copies of a row in different tasks.

    It depends on what a task holds, not on the order it holds it in, so a task that is run
    again gives its rows the same salts.
    """
    plain = [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()]
    return F.xxhash64(F.spark_partition_id(), *plain)


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str],
           counted_on: DataFrame | None = None) -> DataFrame:
    """Left join to a table that is unique on ``keys``; rows of ``left`` are kept as they are.

    Payload columns are the columns of ``right`` other than the keys. They must not clash with
    columns of ``left``. Hot keys are counted on ``left``, or on ``counted_on`` when that is an
    earlier and cheaper form of it with the same keys, such as the table a chain of lookups
    started from. The choice only affects balance, never the rows.
    """
    keys = list(keys)
    payload = [c for c in right.columns if c not in keys]
    clash = set(payload) & set(left.columns)
    if clash:
        raise ValueError(f"lookup columns already present: {sorted(clash)}")

    hot = F.broadcast(hot_hashes(left if counted_on is None else counted_on, keys))
    kinds = dict((left if counted_on is None else counted_on).dtypes)
    salt = (F.when(F.col("_salts").isNotNull(), F.pmod(_spread(left), F.col("_salts")))
            .when(any_null(keys), _spread(left)).otherwise(F.lit(0).cast("bigint")))
    marked = left.withColumn("_hash", _hash(keys, kinds)).join(hot, "_hash", "left").withColumn(
        "_salt", salt).drop("_hash", "_salts")
    salts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1).cast("bigint")) - 1)
    known = right.select(*keys, F.struct(F.lit(True).alias("_there"), *payload).alias("_row"),
                         _hash(keys, kinds).alias("_hash")).join(hot, "_hash", "left").select(
        *keys, "_row", F.explode(salts).alias("_salt"))
    joined = marked.join(known, keys + ["_salt"], "left")
    return joined.select(*left.columns, *[F.col("_row")[c].alias(c) for c in payload])


def members(left: DataFrame, ids: DataFrame, keys: Sequence[str], keep: bool = True,
            counted_on: DataFrame | None = None) -> DataFrame:
    """Semi join (``keep``) or anti join against a list of ids, balanced for hot ids.

    Null keys count as "not in the list".
    """
    listed = ids.filter(~any_null(keys)).select(*keys).distinct().withColumn("_listed", F.lit(True))
    marked = lookup(left, listed, keys, counted_on)
    test = F.col("_listed").isNotNull() if keep else F.col("_listed").isNull()
    return marked.filter(test).drop("_listed")
