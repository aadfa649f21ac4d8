"""Squads rebuilt by name: rows of a name move together, and no key is ranked in ranges or written to be told from its copies."""

from pyspark.sql import functions as F

from matchloom.plans import silver


def test_patched_squads_keep_one_row_a_key_without_a_job(spark):
    raw = spark.createDataFrame([("Club A", "2020", "Uno", "7", "Centre-Back"), ("Club A", "2020", "Uno", "7", "Centre-Back"), ("club a ", "2020", " UNO", "9", "Centre-Back"),
                                 ("Club A", "2020", "Otro Uno", "5", "Centre-Back"), ("Club B", "2020", "Uno", "1", None), ("Club A", None, "Dos", "3", "Goalkeeper"),
                                 ("Club A", "2021", "Nadie", "2", None), ("Club X", "2020", "Uno", "2", None), ("Club A", "2020", None, "1", None), ("Club A", "2020", "Club A", "1", None)],
                                "club string, temporada string, jugador string, numero string, posicion string")
    raw = raw.withColumns({"fecha_fichaje": F.lit("2020-02-01"), "fuente": F.lit("m")})
    catalog = spark.createDataFrame([(1, "Club A"), (2, "Club B")], "id_equipo int, nombre_transfermarkt string")
    # One player under two names, one name of two players, one plain player.
    players = spark.createDataFrame([("Uno", "p1"), ("Otro Uno", "p1"), ("Dos", "p2"), ("Dos", "p3"), (None, "p4")], "jugador string, id_jugador string")
    spark.sparkContext.setJobGroup("patch", "")
    kept, rejects = silver.patch_squads(raw, catalog, players, F.lit("2024-01-01").cast("timestamp"), tasks=3)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("patch")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_near" in plan and "_cut" not in plan
    rows = kept.collect()
    assert sorted((r.id_equipo, r.id_jugador, r.temporada or 0, r.numero_camiseta) for r in rows) == [(1, "p1", 2020, "5"), (1, "p2", 0, "3"), (1, "p3", 0, "3"), (2, "p1", 2020, "1")]
    assert all(len(r.id_plantilla_equipo) == 64 for r in rows)
    found = sorted((r.razon_rechazo, r.numero_camiseta or r.numero) for r in rejects.collect())
    assert found == [("DUPLICADO_CLAVE", "7"), ("DUPLICADO_CLAVE", "9"), ("SIN_MATCH_CATALOGO", "2"), ("SIN_MATCH_MD_PLANTILLAS", "1"), ("SIN_MATCH_MD_PLANTILLAS", "1"), ("SIN_MATCH_MD_PLANTILLAS", "2")]
