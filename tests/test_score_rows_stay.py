"""Rows of scored players move no more than their question needs."""

import pytest
from pyspark.sql import functions as F

from matchloom.functions import fixed
from matchloom.operators import ranking
from matchloom.plans import questions, views


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def planned(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scaling_by_few_groups_moves_no_row(spark, planned):
    df = spark.range(40).select((F.col("id") % 3).alias("g"), F.col("id").alias("v")).unionByName(spark.createDataFrame([(None, 1), (None, None), (None, 5)], "g bigint, v bigint"))
    out = ranking.minmax_by(df, "g", "v")
    assert "Exchange hashpartitioning" not in plan(out)
    got = {(r.g, r.v): r.score_100 for r in out.collect()}
    assert got[0, 0] == 0 and got[0, 39] == 100 and got[None, 1] == 0 and got[None, 5] == 100 and got[None, None] is None and len(got) == 43


def scores(spark):
    rows = [(t, p, e, f"j{i}", float(i)) for i, (t, p, e) in enumerate((t, p, e) for t in (2019, 2020, 2021, None) for p in ("POR", "DC", "ENT", None) for e in (1, 2)) if t != 2021 or p in ("ENT", None)]
    return spark.createDataFrame(rows, "temporada int, posicion_xi string, id_equipo int, id_jugador string, score_100 double")


def test_seasons_of_elevens_need_no_ranks(spark, planned):
    score = scores(spark)
    view = views._seated(score, [("score_100", "desc"), ("id_jugador", "asc")])
    seasons = views.eleven_seasons(score)
    assert {r[0] for r in seasons.collect()} == {r[0] for r in view.select("temporada").collect()} == {2019, 2020, None}
    assert "Window" not in plan(seasons) and set(r[3] for r in fixed.SLOTS) >= {"POR", "DC"}
    from matchloom.operators import filters
    latest = filters.for_season(view, seasons=seasons)
    assert sorted(map(str, latest.collect())) == sorted(map(str, filters.for_season(view).collect())) and latest.count()


def test_only_profiles_of_the_players_shown_move(spark):
    stats = spark.createDataFrame([(f"e{i:03d}", f"p{i % 50}", "Hot Gear" if i % 50 < 20 else "Otro", 2000 + i % 7, i % 3, "A") for i in range(300)],
                                  "id_estadistica_jugador string, id_jugador string, jugador string, temporada int, id_equipo int, nombre_equipo string")
    stats = stats.withColumns({c: F.lit(1) for c in ("goles", "asistencias", "partidos_jugados", "minutos_jugados")}).withColumn("posicion", F.lit("DC"))
    squads = spark.createDataFrame([(f"p{i % 50}", 2000 + i % 7, i % 3, i) for i in range(0, 400, 3)], "id_jugador string, temporada int, id_equipo int, valor_mercado int")
    squads = squads.withColumns({c: F.lit("x") for c in ("altura", "pie", "edad_historica", "nacionalidad_principal")})
    out = questions.player_profile(stats, squads, "hot gear", n=4)
    assert "LeftSemi" in plan(out)
    value = {(r.id_jugador, r.temporada, r.id_equipo): r.valor_mercado for r in squads.collect()}
    chosen = sorted((r for r in stats.collect() if r.jugador == "Hot Gear"), key=lambda r: (-r.temporada, r.id_estadistica_jugador))[:4]
    assert [(r.temporada, r.valor_mercado) for r in out.collect()] == [(r.temporada, value.get((r.id_jugador, r.temporada, r.id_equipo))) for r in chosen]
    assert questions.player_profile(stats, squads, "hot gear", n=None).count() == 120
