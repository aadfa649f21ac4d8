"""Ranking, de-duplication and streaks that stay balanced when one group holds much of the data."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..session import stored
from . import ranges
from .filters import REASON

# An ordering is a list of (column, "asc" | "desc"). The last entries must make it total.
Order = Sequence[tuple[str, str]]


def sort_columns(order: Order) -> list[Column]:
    return [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_first() for c, d in order]


def top_row_per_key(df: DataFrame, keys: Iterable[str], order: Order) -> DataFrame:
    """First row of each group. Catalyst turns the `== 1` filter into a group limit ahead of the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


latest_per_key = top_row_per_key
keep_best_priority = top_row_per_key
best_per = top_row_per_key


def dedup_latest(df: DataFrame, keys: Iterable[str] | None, order: Order = ()) -> DataFrame:
    """Latest row per key by the given order; plain distinct rows without keys."""
    return df.distinct() if not keys else top_row_per_key(df, keys, order)


def first_rows(df: DataFrame, keys: Iterable[str], order: Order, n: int, rank=F.row_number,
               name: str = "rango") -> DataFrame:
    """Rows ranked at most `n` in their group; the literal limit is applied before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn(name, rank().over(w)).filter(F.col(name) <= n)


def dense_rank_in(df: DataFrame, part: Iterable[str], order: Order, at_most: int, name: str = "rango") -> DataFrame:
    return first_rows(df, part, order, at_most, F.dense_rank, name)


def latest_non_blank(df: DataFrame, key: Column | str, order: Order, cols: Iterable[str],
                     blanks: Iterable[str] = tuple(fixed.WINDOW_BLANKS)) -> DataFrame:
    """Per key and column, the value of the latest row where it is not blank: one aggregation, no window.

    A single ascending order column without NULLs is compared directly, which is much cheaper than a struct.
    """
    key = F.col(key) if isinstance(key, str) else key
    rank = F.col(order[0][0]) if len(order) == 1 and order[0][1] == "asc" else _sort_struct(df, order)
    kept = []
    for c in cols:
        value = text.null_if_placeholder(c, blanks)
        kept.append(F.min_by(value, F.when(value.isNotNull(), rank)).alias(c))
    return df.groupBy(key.alias("_key")).agg(*kept)


def _sort_struct(df: DataFrame, order: Order) -> Column:
    """The ordering as one ascending struct; descending entries must be numbers, dates or timestamps."""
    kinds = dict(df.dtypes)
    fields = []
    for i, (c, direction) in enumerate(order):
        if direction == "desc":
            fields += [F.col(c).isNull().alias(f"n{i}"), _reversed(c, kinds[c]).alias(f"v{i}")]
        else:
            fields += [F.col(c).isNotNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)


def _reversed(c: str, kind: str) -> Column:
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return -F.unix_micros(F.col(c).cast("timestamp"))
    if kind == "string":
        raise ValueError(f"descending text order on {c} cannot be cut into ranges")
    return -F.col(c)


def rank_table(df: DataFrame, part: Sequence[str], order: Order, name: str = "posicion",
               splits: int | None = None) -> DataFrame:
    """Exact row number inside each group, with the largest group spread over many tasks (see `ranges.running`)."""
    ranked = ranges.running(df.drop(name), part, _sort_struct(df, order), {name: F.lit(1).cast("long")}, splits=splits)
    return ranked.withColumn(name, F.col(name).cast("int"))


def split_duplicates(df: DataFrame, keys: Sequence[str], order: Order,
                     reason: str = "DUPLICADO_CLAVE") -> tuple[DataFrame, DataFrame]:
    """First row per key is kept, all others are rejected; a key with very many copies is ranked in ranges."""
    ranked = rank_table(df, list(keys), order, "_rn")
    kept = ranked.filter(F.col("_rn") == 1).drop("_rn")
    rejected = ranked.filter(F.col("_rn") > 1).drop("_rn").withColumn(REASON, F.lit(reason))
    return kept, rejected


def split_duplicates_near(df: DataFrame, keys: Sequence[str], order: Order, near: str, whole: str,
                          reason: str = "DUPLICADO_CLAVE") -> tuple[DataFrame, DataFrame]:
    """`split_duplicates` for keys with few copies, without a move, a written table or a second pass over the rows: where the column `whole`
    is true, all rows of a key have one value of `near`, by which they lie together already. Both columns are dropped."""
    parts = [(F.col(whole), [near, *keys]), (~F.col(whole), keys)]

    def half(first: bool) -> DataFrame:
        found = []
        for some, by in parts:
            ranked = df.filter(some).withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*sort_columns(order))))
            found.append(ranked.filter(F.col("_rn") == 1 if first else F.col("_rn") > 1).drop("_rn", near, whole))
        return found[0].unionByName(found[1])

    return half(True), half(False).withColumn(REASON, F.lit(reason))


def number_slots(slots: DataFrame) -> DataFrame:
    w = Window.partitionBy("id_formacion", "posicion_xi").orderBy("orden")
    return slots.withColumn("slot_rank", F.row_number().over(w))


def minmax_by(df: DataFrame, key: str, col: str, name: str = "score_100", digits: int | None = None) -> DataFrame:
    """Scales a column to 0-100 inside each group, 50 where the group is flat; one aggregation and a join.

    The limits are stored, so that their size is known when the join is planned: rows stay where they are if the groups are few."""
    limits = stored(df.groupBy(F.col(key).alias("_g")).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi")))
    scaled = F.when(F.col("_hi") > F.col("_lo"), (F.col(col) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * 100)
    value = F.when(F.col(col).isNotNull(), F.coalesce(scaled, F.lit(50.0)))
    if digits is not None:
        value = F.round(value, digits)
    joined = df.join(limits, F.col(key).eqNullSafe(F.col("_g")), "left")
    return joined.withColumn(name, value).drop("_g", "_lo", "_hi")


def scale_to_max(df: DataFrame, col: str, part: Sequence[str], name: str = "escala", floor: float = 0.01,
                 digits: int = 4) -> DataFrame:
    """Value as a percentage of the largest absolute value of its group; one aggregation and a join."""
    tops = df.groupBy(*part).agg(F.max(F.abs(F.col(col))).alias("_top"))
    scaled = F.col(col) / F.greatest(F.col("_top"), F.lit(floor)) * 100
    return df.join(tops, list(part)).withColumn(name, F.round(scaled, digits)).drop("_top")


def most_complete(df: DataFrame, keys: Iterable[str], cols: Iterable[str], arrival: str) -> DataFrame:
    """Row with most non-blank fields per key; the earliest arrival wins ties."""
    filled = sum((F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False)).cast("int") for c in cols), F.lit(0))
    scored = df.withColumn("_filled", filled)
    return top_row_per_key(scored, keys, [("_filled", "desc"), (arrival, "asc")]).drop("_filled")


def streaks(df: DataFrame, key: Sequence[str], order: Order, cond: Column, splits: int | None = None) -> DataFrame:
    """Runs of consecutive rows that satisfy `cond`: first and last row number and length per run, in one pass."""
    return ranges.runs(df, list(key), _sort_struct(df, order), cond, splits)


def top_n(df: DataFrame, order: Order, n: int | None = None) -> DataFrame:
    """The first n rows of an order; all rows in that order for None."""
    ordered = df.orderBy(*sort_columns(order))
    return ordered if n is None else ordered.limit(n)
