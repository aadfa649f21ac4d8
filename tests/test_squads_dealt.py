"""Squad rows are dealt by count where their number is known, and move without what follows from them."""

import re

from pyspark.sql import functions as F

from matchloom.plans import silver


def rows(spark):
    raw = [(f"Club {i % 5}" if i % 11 else None, str(2000 + i % 3), f"Player {i % 40}" if i % 13 else " ", str(i % 9), "Goalkeeper", "01/02/2020", "m", str(i % 40) if i % 7 else None) for i in range(900)]
    raw = spark.createDataFrame(raw + raw[:30], "club string, temporada string, jugador string, numero string, posicion string, fecha_fichaje string, fuente string, id_tm string")
    catalog = spark.createDataFrame([(i, f"club {i}") for i in range(4)], "id_equipo int, nombre_transfermarkt string")
    players = spark.createDataFrame([(str(i) if i % 2 else None, f"Player {i}", f"k{i}") for i in range(35)], "id_tm string, jugador string, id_jugador string")
    return raw, catalog, players, None, F.lit("2024-01-01").cast("timestamp")


def test_dealing_by_count_changes_no_row(spark):
    cut, dealt = silver.squads(*rows(spark)), silver.squads(*rows(spark), tasks=7)
    for a, b in zip(cut, dealt):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert cut[0].count() > 50 and cut[1].count() > 50


def test_squads_are_dealt_to_the_tasks_given_and_move_without_their_hash(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = silver.squads(*rows(spark), tasks=7)[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Spark takes its own number of partitions for the join with the players where that is greater.
    moves = [(by.split("#")[0], int(n)) for by, n in re.findall(r"Exchange hashpartitioning\((.*?), (\d+)\)", plan)]
    assert ("_near", 7) in moves and ("_pd", 7) in moves and min(n for by, n in moves if by == "_pk") >= 7
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(_near#" in line)
    assert not any("_tie" in line for line in lines[at:]) and any("_tie" in line for line in lines[:at])
