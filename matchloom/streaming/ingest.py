"""Incremental file ingestion: each new file is read once, curated and merged by key."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import quality_metrics, reject_records
from ..sources.readers import path_exists
from ..sources.writers import merge_coalesce, merge_into, merge_upsert, recover, swap_in, write_dynamic_partitions

Batch = Callable[[DataFrame, int], None]


def landing_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None,
                   **options) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).load(path)


def ingest_stream(rows: DataFrame, checkpoint: str, on_batch: Batch) -> StreamingQuery:
    """Processes what has arrived and stops. The checkpoint remembers the files already taken."""
    return (rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def upsert_into(path: str, keys: Sequence[str], curate: Callable[[DataFrame], DataFrame] = lambda d: d,
                keep_known: bool = False, latest: str | None = None, newest: bool = False, by: Sequence[str] = ()) -> Batch:
    """Batch handler that merges curated rows into a lake folder.

    Inside one batch the row with the latest `latest` value wins. With `newest` the stored row also competes, for
    files that arrive out of order. Merging by key makes a repeated batch harmless. With partition columns `by`, which
    must be among the keys (a hash of them, if nothing better), a batch reads and writes only its own partitions; without,
    the whole folder is replaced.
    """
    merge = merge_coalesce if keep_known else merge_upsert

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = one_version(curate(batch), keys, latest)

        def merged(target: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
            if newest:
                known = target.join(fresh.select(*keys), list(keys), "left_semi")
                fresh = one_version(fresh.unionByName(known, allowMissingColumns=True).select(*fresh.columns), keys, latest)
            return merge(target, fresh, keys)

        recover(spark, path)
        if by:
            merge_into(path, rows, keys, by, merged)
        elif path_exists(spark, path):
            swap_in(merged(spark.read.parquet(path), rows, keys), path)
        else:
            swap_in(rows, path)

    return handle


def one_version(rows: DataFrame, keys: Sequence[str], latest: str | None) -> DataFrame:
    others = [c for c in rows.columns if c not in keys]
    rank = F.struct(*([latest] if latest else []), *[F.col(c) for c in others if c != latest])
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("_v"))
    return picked.select(*keys, "_v.*")


def with_quality(handle: Batch, check: Callable[[DataFrame], tuple[DataFrame, DataFrame]], entity: str, layer: str,
                 key: str, reject_path: str, metric_path: str) -> Batch:
    """Splits a batch first: rejects and load metrics go to their folders, kept rows to the handler.

    Both folders are partitioned by the batch number, so a batch that runs again replaces what it wrote."""
    def handle_checked(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            kept, rejected = check(batch)
            write_dynamic_partitions(reject_records(rejected, entity, layer).withColumn("lote", F.lit(batch_id)), reject_path, ["lote"])
            write_dynamic_partitions(quality_metrics(batch, kept, entity, layer, key).withColumn("lote", F.lit(batch_id)), metric_path, ["lote"])
            handle(kept, batch_id)
        finally:
            batch.unpersist()

    return handle_checked
