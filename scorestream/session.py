"""Session defaults used by the bench, the tests and local runs.

On a cluster the session comes from the submitter; nothing in the library
depends on the settings made here.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "scorestream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
