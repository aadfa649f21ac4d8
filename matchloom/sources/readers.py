"""Batch readers for landing files, curated folders and tables."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shape import cast_schema, clean_header

BOM = "﻿"


def _without_bom(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lstrip(BOM) for c in df.columns])


def read_pipe_csv(spark: SparkSession, path: str | Sequence[str], sep: str = "|", glob: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _without_bom(reader.csv(path))


def read_catalog_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_pipe_csv(spark, path, sep=";")


def read_json_document(spark: SparkSession, path: str | Sequence[str], schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_rows(spark: SparkSession, path: str | Sequence[str], data: str = "data",
                   schema: str | None = None) -> DataFrame:
    """Envelope documents -> one row per element of the data list, with the element's fields as columns."""
    return explode_rows(read_json_document(spark, path, schema), data)


def explode_rows(docs: DataFrame, data: str = "data") -> DataFrame:
    return docs.select(F.explode(data).alias("_row")).select("_row.*")


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def read_table(spark: SparkSession, name: str) -> DataFrame | None:
    """Table by name, or lake folder by path; None when it does not exist."""
    if "/" in name:
        return spark.read.parquet(name) if path_exists(spark, name) else None
    return spark.table(name) if spark.catalog.tableExists(name) else None


def hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def discover_year_paths(spark: SparkSession, base: str, start: int, end: int) -> list[str]:
    """Curated folders of the years in [start, end) that hold Parquet files."""
    found = []
    for year in range(start, end):
        folder = f"{base}/stg/{year}/curated"
        fs, jpath = hadoop_path(spark, f"{folder}/*.parquet")
        if fs.globStatus(jpath):
            found.append(folder)
    return found


def filter_files_by_year(files: DataFrame, year: int = 0, name: str = "archivo") -> DataFrame:
    """Files whose name holds the year; every file when no year is given."""
    return files.filter(F.col(name).contains(str(year))) if year else files


def read_csv_for_year(spark: SparkSession, folder: str, year: int = 0) -> DataFrame | None:
    """CSV files of the folder, restricted to a year in the file name; None (no data) when there is none."""
    glob = f"*{year}*.csv" if year else "*.csv"
    fs, jpath = hadoop_path(spark, f"{folder}/{glob}")
    return read_pipe_csv(spark, folder, glob=glob) if fs.globStatus(jpath) else None


def resolve_input_path(mode: str, entity: str, year: int | str, loaded: str = "", base: str = "rdv") -> tuple[str, str]:
    """Source and target folders of a curation run.

    HISTORICO works by year, REPROCESO on the first day of the year, INCREMENTAL on the load date.
    """
    root = f"{base}/{entity}"
    if mode == "HISTORICO":
        return f"{root}/stg/{year}/data", f"{root}/stg/{year}/curated"
    day = f"{year}/01/01" if mode == "REPROCESO" else loaded.split(" ")[0].replace("-", "/")
    return f"{root}/stg/{day}/data", f"{root}/{day}/data"


def read_params(params: DataFrame, names: Sequence[str] | None = None, key: str = "parametro",
                value: str = "valor") -> DataFrame:
    """Key and value rows -> one row with a column per parameter."""
    grouped = params.groupBy()
    pivoted = grouped.pivot(key, list(names)) if names else grouped.pivot(key)
    return pivoted.agg(F.max(value))


def year_range(spark: SparkSession, start: int | Column, end: int | Column) -> DataFrame:
    """Years of the half-open range [start, end)."""
    if isinstance(start, int) and isinstance(end, int):
        return spark.range(start, end).select(F.col("id").cast("int").alias("anio"))
    return spark.range(1).select(F.explode(F.sequence(start, end - 1)).alias("anio"))


def map_csv_columns(df: DataFrame, mapping: Mapping[str, str] | None = None,
                    schema: Mapping[str, str] | None = None) -> DataFrame:
    """Cleans headers, renames source to sink columns and converts types."""
    named = df.toDF(*[clean_header(c.replace("\t", "")) for c in df.columns])
    if mapping:
        named = named.select(*[F.col(s).alias(t) for s, t in mapping.items()])
    return cast_schema(named, schema) if schema else named


def copy_csv_to_parquet(spark: SparkSession, source: str, target: str, mapping: Mapping[str, str] | None = None,
                        schema: Mapping[str, str] | None = None) -> DataFrame:
    map_csv_columns(read_pipe_csv(spark, source), mapping, schema).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


