"""Session settings the operators rely on."""

import os

from pyspark.sql import SparkSession


def build_session(app="colloquy", master=None, partitions=None, memory=None):
    """A session with adaptive execution on.  ``master`` is only for local runs;
    on a cluster everything but the adaptive switches comes from the submitter.

    ``partitions`` is the number of shuffle partitions; on a cluster adaptive execution starts from it and merges
    small ones, so give the largest shuffle over the memory of a task: it never splits more."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(partitions or os.cpu_count()))
            .config("spark.driver.memory", memory or "8g")
        )
    elif partitions:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return builder.getOrCreate()
