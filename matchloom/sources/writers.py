"""Merges as DataFrame joins, and writes that replace folders, partitions or single files.

The `*_into` writers change a table in place. They read and rewrite only the partitions that the new rows touch: the result is
staged in the shared scratch folder first and then replaces those partitions, so that an interrupted run leaves every other
partition as it was, and running the same batch again completes it.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import NO_INFO
from ..session import scratch_dir
from .readers import hadoop_path, path_exists


def one_row_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source grouped by its keys; running it fails when a key occurs twice, as MERGE does.

    The grouping puts the rows where the following join on the same keys needs them.
    """
    others = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(F.first(F.struct(*others)).alias("_s"), F.count(F.lit(1)).alias("_n"))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"merge source repeats a key of {list(keys)}"))).otherwise(F.col("_s"))
    return grouped.withColumn("_s", checked).select(*keys, "_s")


def _merge(target: DataFrame, source: DataFrame, keys: Sequence[str], matched) -> DataFrame:
    """Full outer merge; `matched(column, old, new)` gives the value where both sides have the key.

    Columns that only the source has are added, NULL in rows it does not touch."""
    kinds = dict(source.dtypes)
    new = one_row_per_key(source, keys).withColumn("_new", F.lit(True))
    old = target.select(*keys, F.struct(*[F.col(c) for c in target.columns if c not in keys]).alias("_t"), F.lit(True).alias("_old"))
    both = old.join(new, list(keys), "full_outer")

    def value(c: str) -> Column:
        t = F.col("_t").getField(c)
        if c not in kinds:
            return t.alias(c)
        s = F.col("_s").getField(c)
        return (F.when(F.col("_new").isNull(), t).when(F.col("_old").isNull(), s)
                .otherwise(matched(c, t, s, kinds[c]))).alias(c)

    added = [F.col("_s").getField(c).alias(c) for c in source.columns if c not in target.columns]
    return both.select(*[F.col(c) if c in keys else value(c) for c in target.columns], *added)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take every new value, new keys are inserted, the rest stays."""
    return _merge(target, source, keys, lambda c, old, new, kind: new)


def merge_coalesce(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As upsert, but a NULL new value, or a blank or 'sin informacion' text, keeps the old one."""
    def keep_known(c: str, old: Column, new: Column, kind: str) -> Column:
        known = F.nullif(F.nullif(new, F.lit("")), F.lit(NO_INFO)) if kind == "string" else new
        return F.coalesce(known, old)

    return _merge(target, source, keys, keep_known)


def merge_update_only(target: DataFrame, patch: DataFrame, key: Column, patch_key: str) -> DataFrame:
    """Non-NULL patch values win where the key expression meets the patch key; nothing is inserted."""
    fixes = one_row_per_key(patch, [patch_key]).withColumnRenamed(patch_key, "_pk")
    changed = set(patch.columns) - {patch_key}
    joined = target.withColumn("_key", key).join(fixes, F.col("_key") == F.col("_pk"), "left")
    return joined.select(*[
        F.coalesce(F.col("_s").getField(c), F.col(c)).alias(c) if c in changed else F.col(c) for c in target.columns])


def replace_where(target: DataFrame, fresh: DataFrame, predicate: Column) -> DataFrame:
    """Rows of the target outside the predicate, plus the fresh rows."""
    return target.filter(~F.coalesce(predicate, F.lit(False))).unionByName(fresh, allowMissingColumns=True)


def replace_by_key(existing: DataFrame, batch: DataFrame, keys: Sequence[str], full: bool = False) -> DataFrame:
    """Existing rows whose key is not in the batch, plus the batch; only the batch on request."""
    if full:
        return batch
    return existing.join(batch.select(*keys).distinct(), list(keys), "left_anti").unionByName(batch, allowMissingColumns=True)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """Writes unless the frame is empty; tells whether it wrote. The frame's plan runs once."""
    if mode == "overwrite":
        return swap_in(df, path)
    df.write.mode(mode).parquet(path)
    return True


def write_overwrite(df: DataFrame, path: str, by: Sequence[str] = ()) -> bool:
    """Replaces an existing lake folder, also one that the frame reads from; an empty frame changes nothing."""
    spark = df.sparkSession
    recover(spark, path)
    if not path_exists(spark, path):
        raise ValueError(f"table folder {path} does not exist")
    return swap_in(df, path, by)


def _beside(path: str) -> tuple[str, str]:
    return f"{path.rstrip('/')}__next", f"{path.rstrip('/')}__prev"


def recover(spark: SparkSession, path: str) -> None:
    """Completes or undoes a swap that was interrupted: the old folder comes back unless the new one is in place."""
    fs, target = hadoop_path(spark, path)
    previous = hadoop_path(spark, _beside(path)[1])[1]
    if fs.exists(previous):
        if fs.exists(target):
            fs.delete(previous, True)
        else:
            _rename(fs, previous, target)


def _rename(fs, a, b) -> None:
    if not fs.rename(a, b):
        raise OSError(f"cannot rename {a} to {b}")


def swap_in(df: DataFrame, path: str, by: Sequence[str] = ()) -> bool:
    """Writes beside the folder, then puts the result in its place; `by` keeps its partition layout.

    Between the two renames the folder is missing; `recover` puts it right, and every writer here calls it first."""
    spark = df.sparkSession
    recover(spark, path)
    fresh, old = _beside(path)
    df.write.mode("overwrite").partitionBy(*by).parquet(fresh)
    fs, target = hadoop_path(spark, path)
    previous, staged = hadoop_path(spark, old)[1], hadoop_path(spark, fresh)[1]
    if spark.read.schema(df.schema).parquet(fresh).isEmpty():
        fs.delete(staged, True)
        return False
    if fs.exists(target):
        _rename(fs, target, previous)
    _rename(fs, staged, target)
    fs.delete(previous, True)
    return True


def write_dynamic_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replaces only the partitions present in the frame; an empty frame changes nothing.

    The rebalance hint groups rows by partition value and lets AQE cut a large value into several files.
    """
    (df.hint("rebalance", *[F.col(b) for b in by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def _in_partitions(found: list, by: Sequence[str]) -> Column:
    """Whether a row lies in one of these partitions."""
    inside = F.lit(False)
    for r in found:
        same = F.lit(True)
        for b in by:
            same = same & (F.col(b).isNull() if r[b] is None else F.col(b) == F.lit(r[b]))
        inside = inside | same
    return inside


def _replace_partitions(spark: SparkSession, path: str, touched: DataFrame, by: Sequence[str], change: Callable[[DataFrame], DataFrame]) -> None:
    """The touched partitions become what `change` makes of their rows; those left without rows are removed.

    Their values are collected: as many rows as a batch has partitions."""
    found = touched.select(*by).distinct().collect()
    staged = scratch_dir(spark)
    after = change(spark.read.option("mergeSchema", True).parquet(path).filter(_in_partitions(found, by)))
    after.write.parquet(staged)
    fresh = spark.read.schema(after.schema).parquet(staged)
    write_dynamic_partitions(fresh, path, by)
    for r in set(found) - set(fresh.select(*by).distinct().collect()):
        folder = "/".join(f"{b}={'__HIVE_DEFAULT_PARTITION__' if r[b] is None else r[b]}" for b in by)
        fs, gone = hadoop_path(spark, f"{path.rstrip('/')}/{folder}")
        fs.delete(gone, True)


def merge_into(path: str, rows: DataFrame, keys: Sequence[str], by: Sequence[str], merge=merge_upsert) -> None:
    """Merges rows into a table partitioned by `by`, which must be among the keys; creates it if there is none."""
    spark = rows.sparkSession
    if not set(by) <= set(keys):
        raise ValueError("the partition columns must be among the keys")
    if not path_exists(spark, path):
        write_dynamic_partitions(one_row_per_key(rows, keys).select(*keys, "_s.*").select(*rows.columns), path, by)
        return
    _replace_partitions(spark, path, rows, by, lambda old: merge(old, rows, keys))


def replace_where_into(path: str, fresh: DataFrame, predicate: Column, by: Sequence[str]) -> None:
    """Rows that satisfy the predicate give way to the fresh rows, in the partitions that have either."""
    spark = fresh.sparkSession
    hit = spark.read.parquet(path).filter(predicate).select(*by).unionByName(fresh.select(*by))
    _replace_partitions(spark, path, hit, by, lambda old: replace_where(old, fresh, predicate))


def update_into(path: str, patch: DataFrame, key: Column, patch_key: str, by: Sequence[str]) -> None:
    """Non-NULL patch values win, in the partitions where the key expression meets the patch."""
    spark = patch.sparkSession
    known = patch.select(F.col(patch_key).alias("_pk")).distinct()
    hit = spark.read.parquet(path).withColumn("_key", key).join(known, F.col("_key") == F.col("_pk"), "left_semi")
    _replace_partitions(spark, path, hit, by, lambda old: merge_update_only(old, patch, key, patch_key))


def replace_by_key_into(path: str, batch: DataFrame, keys: Sequence[str], by: Sequence[str]) -> None:
    """Rows whose key is in the batch give way to it; the partition columns must be among the keys."""
    if not set(by) <= set(keys):
        raise ValueError("the partition columns must be among the keys")
    _replace_partitions(batch.sparkSession, path, batch, by, lambda old: replace_by_key(old, batch, keys))


def append_rejects(records: DataFrame, path: str) -> Exception | None:
    """Appends reject or metric rows. A failure must not stop a load, so it is returned, for the caller to report; None if written."""
    try:
        records.write.mode("append").option("mergeSchema", True).parquet(path)
    except Exception as error:  # noqa: BLE001 - quality output never blocks a load
        return error
    return None


def export_csv(tables: dict[str, DataFrame], path: str, one_file: bool = False) -> list[str]:
    """Header and UTF-8 CSV folder per table; several part files unless one file is asked for."""
    written = []
    for name, df in tables.items():
        out = df.coalesce(1) if one_file else df
        out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(f"{path}/{name}")
        written.append(f"{path}/{name}")
    return written
