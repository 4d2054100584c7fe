"""Incremental runs: resume, upserts, retries and counters (``seen`` deduplicates across runs).

Every run uses ``trigger(availableNow=True)``: it takes what is new and ends. What was taken is
in the checkpoint folder, so a run that is broken off is repeated from there. Per-batch output
goes to a folder named after the batch and replaces it, so a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import (Column, DataFrame, Observation, SparkSession, functions as F,
                         types as T)

from .. import values
from ..operators import dedup
from ..operators.enrich import unfinished
from ..operators.ordered import number_rows


def arriving(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
             files_per_batch: int | None = None, **options: str) -> DataFrame:
    """A folder as a stream; new files are new input."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_to_end(writer, checkpoint: str):
    """Start, take everything available, stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_new(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append rows not taken by an earlier run (files already read are not read again)."""
    run_to_end(stream.writeStream.format("parquet").outputMode("append").option("path", out),
               checkpoint)


def batches_of(spark: SparkSession, folder: str) -> DataFrame | None:
    """What is written below a folder; None before the first write."""
    try:
        return spark.read.option("basePath", folder).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def log_changes(stream: DataFrame, log: str, checkpoint: str,
                prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Write every batch under ``log/batch=N``: an upsert that costs one batch, not the table."""
    def write(rows: DataFrame, batch: int) -> None:
        prepare(rows).write.mode("overwrite").parquet(f"{log}/batch={batch}")

    run_to_end(stream.writeStream.foreachBatch(write), checkpoint)


def current_rows(spark: SparkSession, log: str, key: str, order: Sequence[Column]) -> DataFrame:
    """The table a change log stands for: per key the row of the latest batch, then order."""
    changes = spark.read.option("basePath", log).parquet(log)
    return dedup.first_wins(changes, [key], [F.col("batch").desc(), *order]).drop("batch")


def compact(spark: SparkSession, log: str, key: str, order: Sequence[Column], out: str) -> None:
    """Write the current rows as a log of their own, under one batch, in a new folder."""
    current_rows(spark, log, key, order).write.mode("overwrite").parquet(f"{out}/batch=0")


def retry_undecided(todo: DataFrame, done: DataFrame, key: str, outcome: str) -> DataFrame:
    """Rows still to do: those without a decided outcome; undecided ones come again."""
    return unfinished(todo, done.filter(F.col(outcome).isNotNull()), key)


def counters(stream: DataFrame, out: str, checkpoint: str, day: Column,
             order: Sequence[Column], name: str = "counter") -> None:
    """Number rows per day, going on where earlier batches of that day ended.

    A ledger holds one row per batch and day. A batch reads the ledger of smaller batch numbers
    only, so repeating it gives the same numbers.
    """
    ledger = f"{out}/ledger"

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        numbered = number_rows(rows.withColumn("day", day), order, ["day"], "_n")
        earlier = batches_of(spark, ledger)
        if earlier is not None:
            used = earlier.filter(F.col("batch") < batch).groupBy("day").agg(
                F.sum("n").alias("_used"))
            # One row per calendar day, so small enough to broadcast whatever the input.
            numbered = numbered.join(F.broadcast(used), "day", "left")
        else:
            numbered = numbered.withColumn("_used", F.lit(None).cast("bigint"))
        result = numbered.withColumn(
            name, F.col("_n") + F.coalesce(F.col("_used"), F.lit(0))).drop("_n", "_used")
        result.write.mode("overwrite").parquet(f"{out}/rows/batch={batch}")
        written = spark.read.parquet(f"{out}/rows/batch={batch}")
        written.groupBy("day").agg(F.count(F.lit(1)).alias("n")).write.mode(
            "overwrite").parquet(f"{ledger}/batch={batch}")

    run_to_end(stream.writeStream.foreachBatch(write), checkpoint)


def until_quiet(spark: SparkSession, rounds: Callable[[int], DataFrame | None], keys: Sequence[str],
                order: Sequence[Column], out: str,
                max_quiet: int | None = values.MAX_QUIET_ROUNDS) -> int:
    """Run rounds 0, 1, ... and return their number.

    A crawl without an end stops after ``max_quiet`` rounds in a row that bring no new key. Input
    that has an end says so by giving None for a round; with ``max_quiet`` None all of it is read.
    Every round writes its unseen rows, the first per key in ``order``, and one metrics row; the
    rows are counted while they are written.
    """
    number = quiet = 0
    while (given := rounds(number)) is not None:
        rows = dedup.first_wins(given, list(keys), order)
        seen = batches_of(spark, f"{out}/rows")
        # One row per key on either side, so this anti join has no heavy key.
        fresh = rows if seen is None else rows.join(
            seen.filter(F.col("batch") < number).select(*keys), list(keys), "left_anti")
        counted = Observation()
        fresh.observe(counted, F.count(F.lit(1)).alias("added")).write.mode("overwrite").parquet(
            f"{out}/rows/batch={number}")
        added = counted.get["added"]
        spark.createDataFrame([(number, added)], "round bigint, added bigint").write.mode(
            "overwrite").parquet(f"{out}/metrics/batch={number}")
        number += 1
        quiet = quiet + 1 if added == 0 else 0
        if max_quiet is not None and quiet >= max_quiet:
            break
    return number
