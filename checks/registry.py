"""Where every query registers its Spark function and, where SQL can express it, its statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .league import League
from .oracle import league_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Without clock columns, and in types that compare across engines."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if name in ("fecha_carga", "periododia"):
            continue
        if kind.startswith("decimal") or kind == "float":
            c = c.cast("double")
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        elif kind == "boolean":
            c = c.cast("int")
        elif kind.startswith(("array", "map", "struct")):
            c = F.to_json(c)
        out.append(c.alias(name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Registers f(spark, sf_dir)."""
    def register(fn):
        QUERIES[name] = lambda spark, sf: plain(fn(spark, sf))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def league_query(name: str, sql: str | None = None):
    """Registers f(league), with a statement over the league entities."""
    def register(fn):
        QUERIES[name] = lambda spark, sf: plain(fn(League(spark, sf)))
        if sql is not None:
            SQL[name] = league_sql(sql)
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
