"""Session settings for local runs and tests; a cluster session is used as it is given."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, name: str = "matchloom", memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the shared folder the cluster names; a temporary one only in a local session that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "data")


def stored(df: DataFrame) -> DataFrame:
    """Written once to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, rows_a_task: int, *by: str | Column) -> DataFrame:
    """Rows dealt by key to as many tasks as keep each at some `rows_a_task`, where bytes say too little about the work. The rows
    are counted at once, which costs nothing on a stored table. Two tasks at least: one would not count as dealt by key."""
    return df.repartition(tasks_of(df.count(), rows_a_task), *by)


def tasks_of(rows: int, rows_a_task: int) -> int:
    return max(2, -(-rows // rows_a_task))


def spread(df: DataFrame) -> DataFrame:
    """A stored table in at least one partition per core, for rows that are costly to work on. Only a table with fewer
    partitions than cores moves, so its size is bounded."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
