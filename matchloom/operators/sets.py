"""Set operations."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_roles(df: DataFrame, keep: Sequence[str], roles: Mapping[str, Mapping[str, Column]],
                  tag: str) -> DataFrame:
    """One output row per role from a single scan: {role: {output column: expression}}."""
    rows = [F.struct(F.lit(role).alias(tag), *[e.alias(o) for o, e in cols.items()]) for role, cols in roles.items()]
    return df.select(*keep, F.explode(F.array(*rows)).alias("_r")).select(*keep, "_r.*")


def union_distinct(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, dfs).distinct()


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def intersect_values(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_values(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def for_entities(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Rows of any of several entities in one query; names match when they contain the given text."""
    name = F.lower(col)
    return df.filter(reduce(lambda x, y: x | y, [name.contains(v.lower()) for v in values]))


def entities_from_roles(df: DataFrame, cols: Sequence[str], name: str = "equipo") -> DataFrame:
    """Distinct entities over several role columns, read in one scan."""
    listed = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(name))
    return listed.filter(F.col(name).isNotNull()).distinct()
