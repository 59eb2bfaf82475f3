"""Session helper for tests, the benchmark and stand-alone use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, driver_memory: str | None = None,
                  app_name: str = "glotta") -> SparkSession:
    """A session with the settings the operators are tuned for.

    Master, partitions and driver memory are left to the submitted job unless given.

    ``objectHashAggregate.sortBased.fallbackThreshold`` is raised because the
    document-vector mean and the token re-assembly aggregate one small buffer
    per document: the default of 128 groups makes every task sort its exploded
    tokens although they already arrive document by document.
    """
    given = {"spark.master": master, "spark.sql.shuffle.partitions": shuffle_partitions,
             "spark.driver.memory": driver_memory}
    return (
        SparkSession.builder.config(map={k: str(v) for k, v in given.items() if v is not None})
        .appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "16384")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every Column call is slow to build large expressions with.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
