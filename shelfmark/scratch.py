"""Where intermediate tables live.

On a cluster that is the shared folder named by ``spark.checkpoint.dir``. Only a local-mode
session without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """The shared scratch folder of this session."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="run-")
    return _local_roots[app]


def fresh(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the scratch root."""
    return f"{root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let a statement remove its shuffle files when it ends; the setting is put back after it."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back, lineage cut.

    Needed where two readers must see the very same rows, or where a dear step would be
    repeated. Parquet lets each reader take only the columns it needs; a frame Parquet cannot
    hold (untyped null columns) is checkpointed instead. Both survive the loss of executors.
    The shuffle files behind the written table go with the write: nothing reads them again.
    """
    spark = df.sparkSession
    if any(kind == "void" for _, kind in df.dtypes):
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root(spark))
        return df.checkpoint(eager=True)
    path = fresh(spark, "settled")
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
