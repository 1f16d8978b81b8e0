"""Session settings shared by the tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

MAX_SPREAD_SPLITS = 64


def local_session(cpus: int = 8, name: str = "corpusq") -> SparkSession:
    """A local session; on a cluster the submitted configuration is used instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CORPUSQ_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    return builder.getOrCreate()


def one_blas_thread(spark: SparkSession) -> None:
    """Keep numpy in Python workers to the one core its task has.

    A matrix product would otherwise start as many threads as the machine has
    cores in every task, which costs far more than it gains.
    """
    for name in ("OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"):
        spark.sparkContext.environment.setdefault(name, "1")


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a scan that has fewer splits than the cluster has cores.

    Text expressions cost far more CPU than the bytes they read, so a table in
    one small file would keep most cores idle. A table with enough splits, or
    with so many that moving it would cost more than it gains, is returned
    unchanged: no shuffle is added at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits >= cores or splits > MAX_SPREAD_SPLITS:
        return df
    return df.repartition(min(cores, 16 * max(splits, 1)))
