"""Grouped aggregates. All have partial aggregation, so hot keys are reduced before the shuffle."""

from __future__ import annotations

import sys
from functools import reduce
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from . import quantiles

# Functions of this module go to the tasks as code, so that executors need not import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Triangles of sums that a task holds before it hands them on.
GROUPS_HELD = 256

TEAM_MEASURES = {
    "total_pj": "partidos_jugados", "total_pg": "partidos_ganados", "total_pe": "partidos_empatados",
    "total_pp": "partidos_perdidos", "total_goles_favor": "goles_favor", "total_goles_contra": "goles_contra",
    "total_puntos": "puntos",
}
PLAYER_MEASURES = [
    "partidos_jugados", "titularidades", "asistencias", "tarjetas_amarillas", "tarjeta_amarilla_roja",
    "tarjetas_rojas", "entrada_suplente", "salida_suplente", "goles_en_contra", "partidos_imbatido",
    "minutos_jugados",
]


def season_totals(df: DataFrame, keys: Iterable[str] = ("id_equipo", "temporada")) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("tipo_tabla").alias("torneos_disputados"),
        *[F.sum(src).alias(out) for out, src in TEAM_MEASURES.items()],
        (F.sum("goles_favor") - F.sum("goles_contra")).alias("total_diferencia_goles"),
    )


def player_totals(df: DataFrame, keys: Iterable[str] = (
        "id_jugador", "id_tm", "jugador", "id_equipo", "temporada", "periodo")) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in PLAYER_MEASURES],
        F.avg("ppp").alias("ppp"),
        (F.coalesce(F.sum("goles"), F.lit(0)) + F.coalesce(F.sum("penaltis_anotados"), F.lit(0))).alias("goles"),
        F.bool_or("datos_disponibles").alias("datos_disponibles"),
    )


def max_per_key(df: DataFrame, keys: Iterable[str], cols: Iterable[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])


def dedup_max(df: DataFrame, keys: Iterable[str], cols: Iterable[str]) -> DataFrame:
    return max_per_key(df, keys, cols)


def scalar_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias(col))


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def rows_per(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("filas"))


def fill_median(df: DataFrame, col: str) -> DataFrame:
    """Missing values take the exact median of the column, found at once in memory that does not grow with the data."""
    median = quantiles.exact_quantile(df, col)
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(median).cast(df.schema[col].dataType)))


def corr_by(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    return df.groupBy(key).agg(F.corr(x, y).alias("correlacion"))


def gram_by(df: DataFrame, key: str, feats: list[str]) -> DataFrame:
    """Population means and covariances of every feature pair, one small row per group, in one pass.

    Each partition takes its rows of a group in blocks; the squares of sums of the partitions, of fixed size, are merged around their own
    means. A covariance is of the rows that have both values; NaN and infinite values make it NaN."""
    width = len(feats)
    rows = df.select(F.col(key).alias("_key"), *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(feats)])

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        kind, at = pa.null(), TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.column(0).type
            columns = [batch.column(1 + i) for i in range(width)]
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
            given = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
            found = pc.dictionary_encode(batch.column(0), null_encoding="encode")
            of = found.indices.to_numpy(zero_copy_only=False)
            for g in np.unique(of):
                name, mine = found.dictionary[int(g)].as_py(), of == g
                part = (int(mine.sum()), *_square(x[mine], given[mine]))
                held[name] = _merged(held[name], part) if name in held else part
        if held:
            flat = [pa.array([v[i].ravel().tolist() for v in held.values()], pa.list_(pa.float64())) for i in (1, 2, 3)]
            yield pa.record_batch([pa.array(list(held), kind), pa.array([at] * len(held), pa.int32()), pa.array([v[0] for v in held.values()], pa.int64()), *flat],
                                  ["_key", "_at", "_rows", "_n", "_mean", "_co"])

    def whole(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_at").to_pydict()
        parts = [(n, *(np.array(m, dtype="float64").reshape(width, width) for m in ms)) for n, *ms in zip(rows["_rows"], rows["_n"], rows["_mean"], rows["_co"])]
        count, n, mean, co = reduce(_merged, parts)
        out = {"n": pa.array([count], pa.int64())}
        out |= {f"mean_{f}": pa.array([float(mean[i, i]) if n[i, i] else None], pa.float64()) for i, f in enumerate(feats)}
        out |= {f"cov_{feats[i]}__{feats[j]}": pa.array([float(co[i, j] / n[i, j]) if n[i, j] else None], pa.float64()) for i in range(width) for j in range(i, width)}
        return pa.table({"_key": pa.array(rows["_key"][:1], to_arrow_type(kind)), **out})

    names = [f"mean_{f}" for f in feats] + [f"cov_{a}__{b}" for i, a in enumerate(feats) for b in feats[i:]]
    kind, doubles = df.schema[key].dataType, T.ArrayType(T.DoubleType())
    found = rows.mapInArrow(squares, T.StructType([T.StructField("_key", kind), T.StructField("_at", T.IntegerType()), T.StructField("_rows", T.LongType()),
                                                   *[T.StructField(c, doubles) for c in ("_n", "_mean", "_co")]]))
    merged = found.groupBy("_key").applyInArrow(whole, T.StructType([T.StructField("_key", kind), T.StructField("n", T.LongType()),
                                                                      *[T.StructField(c, T.DoubleType()) for c in names]]))
    return merged.withColumnRenamed("_key", key)


def _square(x: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per pair of columns: how many rows have both values, the first one's mean over these, and the sum of products around the means."""
    wild = given & ~np.isfinite(x)
    sound = given & ~wild
    shift = np.where(sound, x, 0.0).sum(axis=0) / np.maximum(sound.sum(axis=0), 1)
    y, v = np.where(sound, x - shift, 0.0), given.astype("float64")
    n, s = v.T @ v, y.T @ v
    mean, co = shift[:, None] + s / np.maximum(n, 1), y.T @ y - s * s.T / np.maximum(n, 1)
    if wild.any():
        bad = wild.astype("float64").T @ v > 0
        mean[bad], co[bad | bad.T] = np.nan, np.nan
    return n, mean, co


def _merged(a: tuple, b: tuple) -> tuple:
    """What `_square` gives for the rows of both, with the number of all rows in front."""
    (rows, n, mean, co), (more, m, other, also) = a, b
    both, apart = np.maximum(n + m, 1), other - mean
    return rows + more, n + m, mean + apart * (m / both), co + also + apart * apart.T * (n * m / both)


def covariances_of_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Population covariance of every two elements of a vector column per group: (key, n, i, j, media_i, media_j, cov), i <= j from 0.

    Each block of rows adds its products to one packed triangle per group; the triangles of the partitions are summed by place. The
    plan does not grow with the vector, and a task holds `GROUPS_HELD` triangles at most. Products are taken around the
    overall means, so that large means do not swallow small variances. Rows whose vector is null, holds null or NaN, or has
    another length than the longest do not count; a null key is a group.
    """
    sound = (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")))
    rows = df.select(F.col(key).alias("_key"), F.col(vector).cast("array<double>").alias("_v")).filter(sound)
    size = rows.agg(F.max(F.size("_v"))).first()[0] or 0
    rows = rows.filter(F.size("_v") == size)
    means = rows.select(F.posexplode("_v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"))
    centre = np.array([r["m"] for r in means.orderBy("i").collect()], dtype="float64")
    upper = np.triu_indices(size)

    def triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(list(held), kind), pa.array([list(v) for v in held.values()], pa.list_(pa.float64()))], ["_key", "_sums"])
            held.clear()
            return batch

        kind = pa.null()
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.column(0).type
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size) - centre
            found = pc.dictionary_encode(batch.column(0), null_encoding="encode")
            of = found.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(of, kind="stable")
            names, starts = np.unique(of[order], return_index=True)
            for g, part in zip(names, np.split(x[order], starts[1:])):
                sums = np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part)[upper]])
                name = found.dictionary[int(g)].as_py()
                held[name] = held[name] + sums if name in held else sums
                if len(held) >= GROUPS_HELD:
                    yield out()
        if held:
            yield out()

    schema = T.StructType([T.StructField("_key", df.schema[key].dataType), T.StructField("_sums", T.ArrayType(T.DoubleType()))])
    sums = (rows.mapInArrow(triangles, schema).select("_key", F.posexplode("_sums").alias("at", "v")).groupBy("_key", "at").agg(F.sum("v").alias("v"))
            .groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("at", "v")))["v"].alias("s")))
    pairs = sums.select("_key", "s", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("i")).select(
        "_key", "s", "i", F.explode(F.sequence(F.col("i"), F.lit(size - 1))).alias("j"))
    middle = F.array(*map(F.lit, centre.tolist()))
    i, j, n = F.col("i"), F.col("j"), F.get("s", F.lit(0))
    at = (F.lit(1 + size) + i * size - F.floor(i * (i - 1) / 2) + (j - i)).cast("int")
    mean = {c: F.get("s", 1 + F.col(c)) / n for c in ("i", "j")}
    return pairs.select(F.col("_key").alias(key), n.cast("long").alias("n"), "i", "j", (F.get(middle, i) + mean["i"]).alias("media_i"),
                        (F.get(middle, j) + mean["j"]).alias("media_j"), (F.get("s", at) / n - mean["i"] * mean["j"]).alias("cov"))


def mode_map(df: DataFrame, key: str, value: str, entity: str | None = None) -> DataFrame:
    """Most frequent value per key; with `entity`, only entities seen under exactly one key are counted."""
    rows = df.filter((F.trim(F.col(value)) != "") & F.col(key).isNotNull())
    if entity is not None:
        single = (df.filter(F.col(key).isNotNull()).groupBy(entity)
                  .agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
                  .filter(F.col("_lo") == F.col("_hi")).select(entity))
        rows = rows.join(single, entity, "left_semi")
    counts = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def keep_matching_mode(df: DataFrame, key: str, value: str, entity: str) -> DataFrame:
    """Drops rows whose value contradicts the most frequent value of their key; blanks and unknown keys stay."""
    modes = mode_map(df, key, value, entity).withColumnRenamed(value, "_mode")
    blank = F.coalesce(F.trim(F.col(value)), F.lit("")) == ""
    return (df.join(modes, key, "left")
            .filter(blank | F.col("_mode").isNull() | (F.col(value) == F.col("_mode"))).drop("_mode"))


