"""Key profiles, load metrics, reject records and input completeness."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text
from .filters import REASON

METRIC_SCHEMA = {
    "id_ejecucion": "int", "id_ejecucion_e2e": "int", "pipeline_id": "int", "capa": "string",
    "tabla_nombre": "string", "registros_entrada": "bigint", "registros_salida": "bigint",
    "registros_descartados": "bigint", "registros_nulos_clave": "bigint", "registros_duplicados": "bigint",
    "observaciones": "string",
}


def profile_key(df: DataFrame, pk: str | Sequence[str], table: str = "") -> DataFrame:
    """Rows, NULL keys, repeated keys and status, from one grouped pass over the key.

    Counting distinct keys by grouping first keeps memory bounded whatever the number of keys.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    nulls = F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    out = groups.agg(total.alias("total"), nulls.alias("nulos_pk"), (total - F.count(F.lit(1))).alias("duplicados_pk"))
    good = (F.col("total") > 0) & (F.col("nulos_pk") == 0) & (F.col("duplicados_pk") == 0)
    return out.select(F.lit(table).alias("tabla"), "total", "nulos_pk", "duplicados_pk",
                      F.when(good, "OK").otherwise("WARN").alias("status"))


def validation_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Key profiles of many tables, one row each; empty tables carry total 0."""
    parts = [profile_key(df, pk, name) for name, (df, pk) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_metrics(entrada: DataFrame, salida: DataFrame, table: str, layer: str, key: str, pipeline_id: int = 0,
                    run: int | None = None, run_e2e: int | None = None, note: str | None = None) -> DataFrame:
    """One typed row of load counts: in, out, discarded, NULL keys, repeated keys."""
    counted = profile_key(salida, key, table)
    rows_in = entrada.agg(F.count(F.lit(1)).alias("n")).scalar()
    values = {
        "id_ejecucion": F.lit(run), "id_ejecucion_e2e": F.lit(run_e2e), "pipeline_id": F.lit(pipeline_id),
        "capa": F.lit(layer), "tabla_nombre": F.col("tabla"), "registros_entrada": rows_in,
        "registros_salida": F.col("total"), "registros_descartados": F.abs(rows_in - F.col("total")),
        "registros_nulos_clave": F.col("nulos_pk"), "registros_duplicados": F.col("duplicados_pk"),
        "observaciones": F.lit(note),
    }
    return counted.select(*[values[c].cast(k).alias(c) for c, k in METRIC_SCHEMA.items()])


def reject_records(df: DataFrame, entity: str, layer: str, reason: str | None = None, mode: str | None = None,
                   period: str | None = None, pipeline_id: int = 0, as_of: Column | None = None) -> DataFrame:
    """Rejected rows packed to JSON with where, why and when; the row's own reason is used when none is given."""
    why = F.lit(reason) if reason is not None else F.col(REASON)
    return df.select(
        text.row_json(df.columns).alias("datos_registro"), F.lit(entity).alias("entidad"), F.lit(layer).alias("capa"),
        F.lit(pipeline_id).alias("pipeline_id"), why.alias(REASON), F.lit(mode).cast("string").alias("modoejecucion"),
        F.lit(period).cast("string").alias("periodo"),
        (F.current_timestamp() if as_of is None else as_of).alias("fecha_carga"),
    )


def expected_inputs(spark: SparkSession, years: Iterable[int], files: Mapping[str, str] = fixed.INPUT_FILES) -> DataFrame:
    """Every entity and year with the file name expected for it."""
    rows = spark.createDataFrame([(e, k) for e, k in files.items()], "entidad string, tipo string")
    listed = rows.withColumn("anio", F.explode(F.array(*[F.lit(int(y)) for y in years])))
    return listed.withColumn("archivo", F.concat_ws("", "entidad", F.lit("_"), F.col("anio").cast("string"), F.lit("."), "tipo"))


def missing_inputs(expected: DataFrame, files: DataFrame, optional: Iterable[str] = ()) -> DataFrame:
    """Expected files that were not delivered; optional entities are exempt."""
    gone = expected.join(files.select("archivo").distinct(), "archivo", "left_anti")
    return gone.filter(~F.col("entidad").isin(list(optional))) if optional else gone
