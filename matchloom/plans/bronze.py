"""Landing data made uniform: headers, clean text, stable column types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sets, shape
from ..sources.readers import discover_year_paths


def curate_json(df: DataFrame, year, as_of: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return shape.complex_to_json(shape.add_missing_metadata(df, year, now))


def curate_csv(df: DataFrame) -> DataFrame:
    return shape.clean_values(shape.normalize_headers(df))


def curate_catalog(df: DataFrame) -> DataFrame:
    return shape.clean_catalog_values(shape.normalize_headers(df))


def unify_history(spark: SparkSession, base: str, start: int, end: int) -> DataFrame:
    """Curated folders of several years as one frame; columns missing in a year are NULL."""
    paths = discover_year_paths(spark, base, start, end)
    if not paths:
        raise ValueError(f"no curated folder under {base} for [{start}, {end})")
    return unify([spark.read.parquet(p) for p in paths])


def unify(parts: list[DataFrame]) -> DataFrame:
    return sets.union_by_name([shape.complex_to_json(p) for p in parts])
