"""Equi-joins for entity resolution and star schemas.

No broadcast is forced: Catalyst and AQE broadcast a dimension when its measured size is below the
session's threshold and fall back to a shuffled join, with skewed partitions split, when it is not.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .filters import REASON
from .ranking import Order, top_row_per_key


def join_by_name(df: DataFrame, dim: DataFrame, left: str, right: str, how: str = "inner") -> DataFrame:
    """Joins on the lowered, trimmed name; the dimension's name column is not kept twice."""
    keyed = dim.withColumn("_name", text.join_name(right)).drop(right)
    return df.join(keyed, text.join_name(left) == F.col("_name"), how).drop("_name")


def lookup(df: DataFrame, dim: DataFrame, col: str, key: str, value: str, default: Column | str | None = None,
           norm=text.join_name) -> DataFrame:
    """Replaces `col` by the looked-up value, else by the default, else keeps it."""
    pairs = dim.select(norm(F.col(key)).alias("_k"), F.col(value).alias("_v")).filter(F.col("_k").isNotNull())
    pairs = pairs.groupBy("_k").agg(F.min("_v").alias("_v"))
    fallback = F.col(col) if default is None else (F.lit(default) if isinstance(default, str) else default)
    joined = df.join(pairs, norm(F.col(col)) == F.col("_k"), "left")
    return joined.withColumn(col, F.coalesce("_v", fallback)).drop("_k", "_v")


def names_of(dim: DataFrame, key: str, names: Sequence[str], norm=text.norm_name) -> DataFrame:
    """One row per (key, normalised name) over several name columns, with the column's rank as priority."""
    listed = dim.select(key, F.posexplode(F.array(*[norm(F.col(n)) for n in names])).alias("_prio", "_name"))
    return listed.filter(F.col("_name") != "")


def join_any_name(df: DataFrame, dim: DataFrame, col: str, names: Sequence[str], key: str,
                  out: str | None = None) -> DataFrame:
    """Left join where the text may equal any of several names: an equi-join on the exploded names."""
    pairs = names_of(dim, key, names).select(F.col(key).alias("_id"), "_name").distinct()
    joined = df.join(pairs, text.norm_name(col) == F.col("_name"), "left").drop("_name")
    return joined.withColumnRenamed("_id", out or key)


def priority_lookup(dim: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """One key per normalised name: the name column listed first wins, then the smallest key."""
    best = F.min_by(F.col(key), F.struct("_prio", key)).alias(key)
    return names_of(dim, key, names).groupBy("_name").agg(best)


def resolve_by_priority(df: DataFrame, dim: DataFrame, col: str, key: str, names: Sequence[str]) -> DataFrame:
    found = priority_lookup(dim, key, names)
    return df.join(found, text.norm_name(col) == F.col("_name"), "left").drop("_name")


def join_roles(df: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, Mapping[str, str]],
               how: str = "left") -> DataFrame:
    """Joins one dimension once per role: {fact key: {dimension column: output column}}."""
    for fact_key, outputs in roles.items():
        side = dim.select(F.col(key).alias("_role"), *[F.col(c).alias(o) for c, o in outputs.items()])
        df = df.join(side, F.col(fact_key) == F.col("_role"), how).drop("_role")
    return df


def match_split(df: DataFrame, dim: DataFrame, on: Mapping[str, str] | Column, reason: str,
                keep: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Matched rows with the dimension's `keep` columns, and the rows without a match with the reason.

    `on` maps a column of `df` to a column of `dim`. The dimension must be unique on it.
    """
    left_keys, right_keys = list(on), list(on.values())
    side = dim.select(*[F.col(r).alias(f"_d{i}") for i, r in enumerate(right_keys)], *keep, F.lit(1).alias("_hit"))
    cond = None
    for i, l in enumerate(left_keys):
        one = F.col(l) == F.col(f"_d{i}")
        cond = one if cond is None else cond & one
    helpers = [f"_d{i}" for i in range(len(right_keys))]
    joined = df.join(side, cond, "left").drop(*helpers)
    matched = joined.filter(F.col("_hit").isNotNull()).drop("_hit")
    missed = joined.filter(F.col("_hit").isNull()).select(*df.columns).withColumn(REASON, F.lit(reason))
    return matched, missed


def join_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    return a.join(b, list(keys), how)


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], how: str = "left") -> DataFrame:
    for dim, keys in dims:
        fact = fact.join(dim, list(keys), how)
    return fact


def join_fallback_key(a: DataFrame, b: DataFrame, ident: str, name: str, how: str = "left") -> DataFrame:
    """Joins on the external id, or on the normalised name where there is no id."""
    left = a.withColumn("_pk", text.player_key(ident, name))
    right = b.withColumn("_pk", text.player_key(ident, name)).drop(ident, name)
    return left.join(right, "_pk", how).drop("_pk")


def assign_slots(ranked: DataFrame, slots: DataFrame, keys: Sequence[str] = ("id_formacion", "posicion_xi"),
                 rank: str = "player_rank") -> DataFrame:
    """Player ranked n takes the n-th slot of its formation and position."""
    numbered = slots.withColumnRenamed("slot_rank", rank)
    return ranked.join(numbered, [*keys, rank], "inner")


def restrict_top_n(df: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """Rows of the n keys with the largest sum of the measure."""
    top = (df.groupBy(key).agg(F.sum(measure).alias("_total"))
           .orderBy(F.col("_total").desc_nulls_last(), F.col(key)).limit(n).select(key))
    return df.join(top, key, "left_semi")


def with_rival(df: DataFrame, teams: DataFrame) -> DataFrame:
    names = teams.select(F.col("id_equipo").alias("_rival"), F.col("nombre_equipo").alias("rival"))
    return df.join(names, F.col("id_rival") == F.col("_rival"), "inner").drop("_rival")


def join_dedup(a: DataFrame, b: DataFrame, key: str, order: Order, how: str = "inner") -> DataFrame:
    return a.join(top_row_per_key(b, [key], order), key, how)


def missing_from(expected: DataFrame, df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return expected.join(df.select(*keys).distinct(), keys, "left_anti")


def common_values(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Rows of both sides whose value occurs on both sides."""
    shared = a.select(col).intersect(b.select(col))
    return a.unionByName(b, allowMissingColumns=True).join(shared, col, "left_semi")
