"""Row filters and two-way splits. Splits return (kept, rejected) and lose no row."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "razon_rechazo"


def split_rule(df: DataFrame, ok: Column, reason: str = "REGLA_NEGOCIO") -> tuple[DataFrame, DataFrame]:
    passed = F.coalesce(ok, F.lit(False))
    return df.filter(passed), df.filter(~passed).withColumn(REASON, F.lit(reason))


def split_null_key(df: DataFrame, key: str, reason: str = "CLAVE_NULA") -> tuple[DataFrame, DataFrame]:
    return split_rule(df, F.col(key).isNotNull(), reason)


def only_true(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col))


def for_period(df: DataFrame, period: int = 0, col: str = "periodo") -> DataFrame:
    return df if not period else df.filter(F.col(col) == period)


def at_least(df: DataFrame, col: str, n) -> DataFrame:
    return df.filter(F.col(col) >= n)


def between_opt(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    if lo is not None:
        df = df.filter(F.col(col) >= lo)
    return df if hi is None else df.filter(F.col(col) <= hi)


def latest_season(df: DataFrame, col: str = "temporada", cond: Column | None = None, seasons: DataFrame | None = None) -> DataFrame:
    """Rows of the largest season; with `cond`, the largest season among rows that satisfy it. `seasons` is a cheaper table
    with the same seasons, for a view that would be worked out twice."""
    known = df if seasons is None else seasons
    top = (known if cond is None else known.filter(cond)).agg(F.max(col).alias("_top"))
    return df.filter(F.col(col) == top.scalar())


def for_season(df: DataFrame, season: int | None = None, col: str = "temporada",
               cond: Column | None = None, seasons: DataFrame | None = None) -> DataFrame:
    return latest_season(df, col, cond, seasons) if season is None else df.filter(F.col(col) == season)


def any_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.filter(F.greatest(*[F.col(c).isNotNull() for c in cols]))


def non_blank(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.trim(F.col(col)) != "")


def having(grouped: DataFrame, cond: Column) -> DataFrame:
    return grouped.filter(cond)
