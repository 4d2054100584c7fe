"""Session builder used by the tests and the bench.

Nothing in the package depends on these settings for its results: functions avoid the session
time zone and the map duplicate policy, so a session made elsewhere gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "shelfmark", cores: str = "*", shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A local session, with adaptive execution and skew-join splitting on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
