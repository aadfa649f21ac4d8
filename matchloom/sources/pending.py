"""Registered input paths: read what is pending, acknowledge after the write succeeded."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import dedup_latest
from .writers import merge_upsert

PATHS = "id bigint, entidad string, modoejecucion string, periodo string, rutaraw string, flg_udv string"


def pending_paths(registry: DataFrame, entity: str, mode: str) -> DataFrame:
    return registry.filter((F.col("flg_udv") == "N") & (F.col("entidad") == entity) & (F.col("modoejecucion") == mode))


def register_paths(registry: DataFrame, fresh: DataFrame) -> DataFrame:
    """Historical paths are put back to pending when they are known; all other paths are added as new rows."""
    keys = ["entidad", "modoejecucion", "rutaraw"]
    known = fresh.filter(F.col("modoejecucion") == "HISTORICO").select(*keys).distinct().withColumn("_again", F.lit(True))
    reset = (registry.join(known, keys, "left")
             .withColumn("flg_udv", F.when(F.col("_again"), F.lit("N")).otherwise(F.col("flg_udv")))
             .select(*registry.columns))
    historic = F.col("modoejecucion") == "HISTORICO"
    added = fresh.filter(historic).join(registry.select(*keys), keys, "left_anti").unionByName(fresh.filter(~historic))
    return reset.unionByName(added.withColumn("flg_udv", F.lit("N")).select(*registry.columns))


def read_pending(spark: SparkSession, registry: DataFrame, entity: str, mode: str,
                 dedup_cols: Sequence[str] = (), loaded: str = "fecha_carga") -> tuple[DataFrame, DataFrame] | None:
    """Rows of all pending paths in one read, latest load per key, and the registry rows to acknowledge.

    The list of paths is control data; the rows themselves stay distributed.
    """
    todo = pending_paths(registry, entity, mode)
    paths = [r["rutaraw"] for r in todo.select("rutaraw").distinct().toLocalIterator()]
    if not paths:
        return None
    rows = spark.read.option("mergeSchema", True).parquet(*paths)
    return latest_rows(rows, dedup_cols, loaded), todo


def latest_rows(rows: DataFrame, dedup_cols: Sequence[str], loaded: str = "fecha_carga") -> DataFrame:
    """Latest load per key with a fixed choice among equal load times; distinct rows without keys."""
    if not dedup_cols:
        return rows.distinct()
    tie: Column = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    order = [(loaded, "desc")] if loaded in rows.columns else []
    return dedup_latest(rows.withColumn("_tie", tie), list(dedup_cols), [*order, ("_tie", "asc")]).drop("_tie")


def acknowledge(registry: DataFrame, done: DataFrame) -> DataFrame:
    return merge_upsert(registry, done.withColumn("flg_udv", F.lit("S")), ["id"])
