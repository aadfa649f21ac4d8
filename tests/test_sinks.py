"""Merges, folder and partition replacement, pending paths, streams."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from matchloom.operators import filters
from matchloom.plans import bronze
from matchloom.sources import pending, readers, writers
from matchloom.streaming import ingest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_coalesce_keeps_known_values(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, s string, n int")
    new = spark.createDataFrame([(1, "", None), (2, "sin informacion", 20), (4, "", None)], "k int, s string, n int")
    once = writers.merge_coalesce(old, new, ["k"])
    assert rows(once) == [(1, "a", 1), (2, "b", 20), (3, "c", 3), (4, "", None)]
    assert rows(writers.merge_coalesce(once, new, ["k"])) == rows(once)


def test_merge_fails_on_repeated_source_keys(spark):
    old = spark.createDataFrame([(1, "a")], "k int, s string")
    new = spark.createDataFrame([(1, "x"), (1, "y")], "k int, s string")
    with pytest.raises(PySparkException, match="repeats a key"):
        writers.merge_upsert(old, new, ["k"]).collect()


def test_update_only_never_inserts(spark):
    old = spark.createDataFrame([(" Ana ", "x", 1.0), ("Luis", "y", 2.0)], "jugador string, pie string, altura double")
    patch = spark.createDataFrame([("ana", None, 1.8), ("nadie", "z", 9.0)], "jugador string, pie string, altura double")
    got = writers.merge_update_only(old, patch, F.lower(F.trim("jugador")), "jugador")
    assert rows(got) == [(" Ana ", "x", 1.8), ("Luis", "y", 2.0)]


def test_an_interrupted_swap_loses_nothing(spark, folder):
    path = f"{folder}/t"
    spark.range(5).write.parquet(path)
    os.rename(path, f"{path}__prev")  # stopped between the two renames
    handle = ingest.upsert_into(path, ["id"])
    handle(spark.range(5, 6), 0)
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(6)]
    spark.range(1).write.parquet(f"{path}__prev")  # stopped before the old folder was deleted
    handle(spark.range(6, 7), 1)
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(7)]
    assert not os.path.exists(f"{path}__prev") and not os.path.exists(f"{path}__next")


def test_partition_scoped_writers(spark, folder):
    path, keys = f"{folder}/t", ["k", "p"]
    schema = "k int, p int, v string"
    writers.merge_into(path, spark.createDataFrame([(1, 0, "a"), (2, 0, "b"), (3, 1, "c"), (4, None, "d")], schema), keys, ["p"])
    other = set(os.listdir(f"{path}/p=1"))
    batch = spark.createDataFrame([(2, 0, "B", 7), (5, 2, "e", 8)], schema + ", extra int")
    for _ in range(2):  # a replay changes nothing
        writers.merge_into(path, batch, keys, ["p"], lambda old, new, ks: writers.merge_upsert(old, new, ks))
    got = spark.read.option("mergeSchema", True).parquet(path).select("k", "p", "v")
    assert set(os.listdir(f"{path}/p=1")) == other
    assert rows(got) == sorted([(1, 0, "a"), (2, 0, "B"), (3, 1, "c"), (4, None, "d"), (5, 2, "e")], key=repr)
    writers.replace_where_into(path, spark.createDataFrame([(9, 0, "z")], schema), F.col("p") <= 1, ["p"])
    assert rows(spark.read.parquet(path).select("k", "p").filter("p is not null")) == [(5, 2), (9, 0)]
    assert not os.path.exists(f"{path}/p=1")


def test_a_replayed_batch_counts_once(spark, folder):
    handle = ingest.with_quality(ingest.upsert_into(f"{folder}/t", ["k", "p"], by=["p"]), lambda b: filters.split_rule(b, F.col("v") >= 0), "e", "UDV", "k", f"{folder}/rej", f"{folder}/met")
    batch = spark.createDataFrame([(1, 0, 1), (2, 0, -1)], "k int, p int, v int")
    for _ in range(3):
        handle(batch, 4)
    assert spark.read.parquet(f"{folder}/rej").count() == 1 and spark.read.parquet(f"{folder}/met").count() == 1
    assert spark.read.parquet(f"{folder}/t").count() == 1


def test_dynamic_partitions_leave_others_untouched(spark, folder):
    path = f"{folder}/t"
    df = spark.createDataFrame([(1, 2020), (2, 2021)], "v int, periodo int")
    writers.write_dynamic_partitions(df, path, ["periodo"])
    before = set(os.listdir(f"{path}/periodo=2020"))
    for _ in range(2):
        writers.write_dynamic_partitions(spark.createDataFrame([(9, 2021)], "v int, periodo int"), path, ["periodo"])
    assert rows(spark.read.parquet(path)) == [(1, 2020), (9, 2021)]
    assert set(os.listdir(f"{path}/periodo=2020")) == before


def test_overwrite_of_a_folder_being_read(spark, folder):
    path = f"{folder}/t"
    with pytest.raises(ValueError):
        writers.write_overwrite(spark.range(1), path)
    spark.range(3).write.parquet(path)
    assert writers.write_overwrite(spark.read.parquet(path).withColumn("id", F.col("id") + 10), path)
    assert not writers.write_overwrite(spark.range(0), path)
    assert rows(spark.read.parquet(path)) == [(10,), (11,), (12,)]


def test_pending_paths_are_acknowledged_after_the_write(spark, folder):
    spark.createDataFrame([(1, "a", "2024-01-01")], "k int, v string, fecha_carga string").write.parquet(f"{folder}/a")
    spark.createDataFrame([(1, "b", "2024-02-01", 5)], "k int, v string, fecha_carga string, extra int").write.parquet(f"{folder}/b")
    registry = spark.createDataFrame([(1, "e", "INC", "p", f"{folder}/a", "N"), (2, "e", "INC", "p", f"{folder}/b", "N"), (3, "e", "HISTORICO", "p", "x", "S")], pending.PATHS)
    got, todo = pending.read_pending(spark, registry, "e", "INC", ["k"])
    assert [(r.k, r.v, r.extra) for r in got.collect()] == [(1, "b", 5)]
    done = pending.acknowledge(registry, todo)
    assert pending.read_pending(spark, done, "e", "INC") is None
    again = pending.register_paths(done, spark.createDataFrame([(3, "e", "HISTORICO", "p", "x", ""), (4, "e", "INC", "p", "y", "")], pending.PATHS))
    assert sorted((r.id, r.flg_udv) for r in again.collect()) == [(1, "S"), (2, "S"), (3, "N"), (4, "N")]


def test_csv_with_bom_and_years(spark, folder):
    with open(f"{folder}/equipos_2024.csv", "w", encoding="utf-8-sig") as f:
        f.write("club|valor\nA|1\n")
    with open(f"{folder}/equipos_2023.csv", "w", encoding="utf-8-sig") as f:
        f.write("club|valor\nB|2\n")
    assert rows(readers.read_csv_for_year(spark, folder, 2024)) == [("A", "1")]
    assert readers.read_csv_for_year(spark, folder, 1999) is None
    assert readers.resolve_input_path("REPROCESO", "equipos", 2024) == ("rdv/equipos/stg/2024/01/01/data", "rdv/equipos/2024/01/01/data")
    assert readers.resolve_input_path("INCREMENTAL", "equipos", 2024, "2024-05-06 10:00:00")[1] == "rdv/equipos/2024/05/06/data"


def test_unify_history_fills_missing_columns(spark, folder):
    spark.createDataFrame([(1, ["x"])], "k int, l array<string>").write.parquet(f"{folder}/stg/2020/curated")
    spark.createDataFrame([(2, "y")], "k int, extra string").write.parquet(f"{folder}/stg/2021/curated")
    got = bronze.unify_history(spark, folder, 2019, 2022)
    assert rows(got.select("k", "l", "extra")) == [(1, '["x"]', None), (2, None, "y")]


def test_stream_run_twice_over_a_growing_folder(spark, folder):
    src, out, ckpt = f"{folder}/in", f"{folder}/out", f"{folder}/ckpt"
    handle = ingest.with_quality(ingest.upsert_into(out, ["k"], latest="t"), lambda b: filters.split_rule(b, F.col("v") >= 0), "e", "UDV", "k", f"{folder}/rej", f"{folder}/met")
    schema = "k int, v int, t int"
    for batch in ([(1, 1, 1), (2, 2, 1), (3, -1, 1)], [(1, 10, 2), (4, 4, 2)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
        ingest.ingest_stream(ingest.landing_stream(spark, src, schema), ckpt, handle).awaitTermination()
    ingest.ingest_stream(ingest.landing_stream(spark, src, schema), ckpt, handle).awaitTermination()
    assert rows(spark.read.parquet(out).select("k", "v", "t")) == [(1, 10, 2), (2, 2, 1), (4, 4, 2)]
    assert spark.read.parquet(f"{folder}/rej").count() == 1
    assert spark.read.parquet(f"{folder}/met").agg(F.sum("registros_entrada")).first()[0] == 5


def test_lost_quality_rows_are_reported(spark, tmp_path):
    rows = spark.range(3)
    (tmp_path / "file").write_text("x")
    assert writers.append_rejects(rows, str(tmp_path / "ok")) is None and spark.read.parquet(str(tmp_path / "ok")).count() == 3
    assert isinstance(writers.append_rejects(rows, str(tmp_path / "file" / "below")), Exception)
