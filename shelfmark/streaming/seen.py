"""Exact deduplication across runs: a table of keys already written, in hash buckets.

A key may come back after any time, so nothing is forgotten and nothing is held in a state store.
The seen keys are a bucketed table below a folder. A batch keeps the first row of each of its keys
(one row per key and task leaves the map side), shuffles those into the table's buckets and meets
the seen keys there; the table itself is read and appended bucket by bucket and never shuffled.

Every key is stored with the number of the batch that brought it, and a batch looks only at keys of
smaller numbers. A batch that is repeated after a failure therefore finds the same new rows, replaces
its own output folder, and adds keys that are there already, which changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import dedup
from .incremental import batches_of, run_to_end

BUCKETS = 64     # of a new store; a bucket of keys should fit one task


class SeenKeys:
    """The key store in a folder. The number of buckets is fixed when the folder is made."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.folder = folder.rstrip("/")
        spec = batches_of(spark, f"{self.folder}/spec")
        if spec is None:
            spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(
                f"{self.folder}/spec")
            spec = spark.read.parquet(f"{self.folder}/spec")
        self.buckets = spec.first()["buckets"]
        self.table = "seen_" + md5(self.folder.encode()).hexdigest()
        # The catalog of a new session does not know the folder: this only names what is there.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (_key BINARY, _batch BIGINT) "
                  f"USING parquet CLUSTERED BY (_key) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.folder}/keys'")

    @staticmethod
    def digest(keys: Sequence[str]) -> Column:
        """One value per key; nulls are values like others, and 1 and "1" differ."""
        return F.unhex(F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256))

    def before(self, spark: SparkSession, batch: int) -> DataFrame:
        return spark.table(self.table).where(F.col("_batch") < batch).select("_key")

    def unseen(self, rows: DataFrame, keys: Sequence[str], order: Sequence[Column],
               batch: int) -> DataFrame:
        """The first row of each key that no smaller batch has brought, with its ``_key``."""
        first = dedup.first_wins(rows.withColumn("_key", self.digest(keys)), ["_key"], order)
        placed = first.repartition(self.buckets, "_key")
        # The batch's keys are the small side of a bucket, so the store streams past them unsorted.
        known = self.before(rows.sparkSession, batch).join(
            placed.select("_key").hint("shuffle_hash"), "_key", "left_semi")
        return placed.join(known.hint("shuffle_hash"), "_key", "left_anti")

    def add(self, keys: DataFrame, batch: int) -> None:
        """Store the column ``_key`` of new rows: one file per bucket."""
        keys.select("_key", F.lit(batch).cast("bigint").alias("_batch")).repartition(
            self.buckets, "_key").write.insertInto(self.table)

    def compact(self, spark: SparkSession, folder: str) -> SeenKeys:
        """The same keys in a new folder, one file per bucket and one row per key."""
        packed = SeenKeys(spark, folder, self.buckets)
        spark.table(self.table).groupBy("_key").agg(F.min("_batch").alias("_batch")).write.insertInto(
            packed.table)
        return packed

    def forget_name(self, spark: SparkSession) -> None:
        """Drop the catalog entry; the folder stays."""
        spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def append_unseen(stream: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str,
                  store: str, checkpoint: str, buckets: int = BUCKETS) -> None:
    """Append to ``out/batch=N`` the first row of every key that no earlier batch or run wrote.

    ``order`` decides between rows of one batch and should be total.
    """
    spark = stream.sparkSession
    seen = SeenKeys(spark, store, buckets)

    def write(rows: DataFrame, batch: int) -> None:
        folder = f"{out}/batch={batch}"
        seen.unseen(rows, keys, order, batch).write.mode("overwrite").parquet(folder)
        seen.add(rows.sparkSession.read.parquet(folder), batch)

    run_to_end(stream.writeStream.foreachBatch(write), checkpoint)


def written(spark: SparkSession, out: str) -> DataFrame:
    """The rows ``append_unseen`` has written so far."""
    return spark.read.option("basePath", out).parquet(out).drop("_key", "batch")
