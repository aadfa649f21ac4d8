"""Rows with hashed keys move as few times as the job needs, and as bytes."""

import datetime

import pytest
from pyspark.sql import functions as F

from checks import league
from matchloom.functions import text
from matchloom.operators import parsing, ranking
from matchloom.plans import gold, scoring, silver, views

HEX = "0a" * 32


@pytest.fixture
def shuffled(spark):
    """Joins as on large tables: no side is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def moves(df) -> int:
    """How often rows of a plan go through an exchange."""
    return df._jdf.queryExecution().executedPlan().toString().count(" Exchange ")


def test_packed_keys_give_their_text_back(spark):
    keys = [HEX, HEX.upper(), HEX[:-1], HEX + "\n", "", "k1", "ñandú", "z" * 31, "z" * 32, "z" * 64, None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").withColumn("p", text.packed_key("k"))
    rows = df.select("k", "p", text.unpacked_key("p").alias("back")).collect()
    assert [r["back"] for r in rows] == keys
    assert len({None if r["p"] is None else bytes(r["p"]) for r in rows}) == len(keys) and len(rows[0]["p"]) == 32


def squad_rows(spark):
    catalog = spark.createDataFrame([(1, "A", "Club A"), (2, "B", "Club B")], "id_equipo int, nombre_equipo string, nombre_transfermarkt string")
    # Two texts of one player, a third player, and a text that nobody has.
    players = spark.createDataFrame([("p1", "10", "Uno"), ("p1", "11", "Uno bis"), ("p2", None, "Dos")], "id_jugador string, id_tm string, jugador string")
    raw = spark.createDataFrame(
        [("Club A", "2020", "Uno", "9", "Goalkeeper", "10"), ("Club A", "2020", "Uno bis", "8", "Goalkeeper", "11"), ("Club A", "2020", "Dos", "7", "Left-Back", None),
         ("Club A", "2020", "Dos", "6", "Left-Back", None), ("Club B", "2020", "Uno", "9", "Goalkeeper", "10"), ("Club A", "2020", "Nadie", "1", "Goalkeeper", None),
         ("Club X", "2020", "Uno", "9", "Goalkeeper", "10"), (None, "2020", "Uno", "9", "Goalkeeper", "10")],
        "club string, temporada string, jugador string, numero string, posicion string, id_tm string").withColumn("fecha_fichaje", F.lit("01/02/2020")).withColumn("fuente", F.lit("f"))
    return raw, catalog, players


def test_squads_keep_one_row_per_player_whatever_the_texts(spark, shuffled):
    ok, rejects = silver.squads(*squad_rows(spark), None, F.lit("2024-01-01").cast("timestamp"))
    found = sorted((r["id_equipo"], r["id_jugador"], r["numero_camiseta"], r["fecha_fichaje"]) for r in ok.collect())
    day = datetime.date(2020, 2, 1)
    assert found == [(1, "p1", "8", day), (1, "p2", "6", day), (2, "p1", "9", day)]
    assert sorted((r["club"] or "", r["jugador"], r["razon_rechazo"]) for r in rejects.collect()) == [
        ("", "Uno", "SIN_MATCH_CATALOGO"), ("Club A", "Nadie", "SIN_MATCH_DIMENSION"), ("Club X", "Uno", "SIN_MATCH_CATALOGO")]


def test_statistics_positions_and_profiles_meet_in_one_move(spark, shuffled):
    stats = spark.createDataFrame([("p1", "10", "Uno", 1, 2020, 2020, 3), ("p1", "10", "Uno", 1, 2020, 2020, 4), ("p1", "10", "Uno", None, 2020, 2020, 5), (None, "1", "X", 1, 2020, 2020, 6)],
                                  "id_jugador string, id_tm string, jugador string, id_equipo int, temporada int, periodo int, goles int")
    blank = ["partidos_jugados", "titularidades", "asistencias", "tarjetas_amarillas", "tarjeta_amarilla_roja", "tarjetas_rojas", "entrada_suplente", "salida_suplente",
             "goles_en_contra", "partidos_imbatido", "minutos_jugados", "penaltis_anotados"]
    stats = stats.withColumns({c: F.lit(90) for c in blank}).withColumns({"ppp": F.lit(1.5), "datos_disponibles": F.lit(True)})
    players = spark.createDataFrame([("p1", "u", "ES"), (None, "n", "FR")], "id_jugador string, foto_url string, nacionalidad_principal string")
    squads = spark.createDataFrame([("p1", 1, 2020, "Defensa"), ("p1", 1, 2020, "Portero"), ("p1", None, 2020, "Medio"), ("p9", 1, 2020, "Medio")], "id_jugador string, id_equipo int, temporada int, posicion string")
    dim = spark.createDataFrame([(1, "A", "a")], "id_equipo int, nombre_equipo string, alias_equipo string")
    out = gold.player_season_stats(stats, players, squads, dim, F.lit("2024-01-01").cast("timestamp"))
    assert sorted(((r["id_jugador"], r["id_equipo"] or 0, r["goles"], r["posicion"]) for r in out.collect())) == [("p1", 0, 95, None), ("p1", 1, 187, "Portero")]
    # Facts, profiles, and both sides of the teams' join; it took seven moves before.
    assert moves(out) <= 4


def test_profiles_of_the_own_team_come_first(spark, shuffled):
    squads = spark.createDataFrame([("p1", 2020, 1, "b", "left", 1.8, "Portero"), ("p1", 2020, 2, "a", None, 1.7, "Medio"), ("p2", 2020, 3, None, "right", 1.6, "Medio"),
                                    ("p2", 2020, 4, "a", "left", 1.5, "Medio")], "id_jugador string, temporada int, id_equipo int, id_plantilla_equipo string, pie string, altura double, posicion string")
    stats = spark.createDataFrame([("p1", 2020, 1), ("p1", 2020, 2), ("p1", 2020, 9), ("p2", 2020, None), ("p3", 2020, 1)], "id_jugador string, temporada int, id_equipo int")
    stats = stats.withColumns({c: F.lit(1) for parts, _ in scoring.RATES.values() for c in parts}).withColumn("minutos_jugados", F.lit(900))
    out = scoring.player_features(stats, squads, 1).collect()
    found = sorted((r["id_jugador"], r["id_equipo"] or 0, r["pie"], r["altura"]) for r in out)
    assert found == [("p1", 1, "left", 1.8), ("p1", 2, None, 1.7), ("p1", 9, None, 1.7), ("p2", 0, "right", 1.6), ("p3", 1, None, 1.7)]


def test_lines_become_texts_in_tasks_of_bounded_size(spark, folder, monkeypatch):
    monkeypatch.setattr(league, "LINES_A_TASK", 10)
    spark.range(95).select(F.col("id").alias("l_partkey"), (F.col("id") % 3).alias("l_suppkey")).write.parquet(f"{folder}/lineitem.parquet")
    dealt = league.League(spark, folder).lines("l_partkey", "l_suppkey")
    assert dealt.rdd.getNumPartitions() == 10 and dealt.count() == 95


def test_players_are_ranked_before_they_are_repeated_for_formations(spark, shuffled):
    rows = [(f"p{i}", 1 + i % 2, 2020, "DFC", float(i % 5)) for i in range(14)] + [("q", 1, 2020, "POR", None), ("r", 1, 2020, None, 1.0)]
    players = spark.createDataFrame(rows, "id_jugador string, id_equipo int, temporada int, posicion_xi string, score_100 double")
    seated = views._seated(players, [("score_100", "desc"), ("id_jugador", "asc")])
    slots = ranking.number_slots(views.formation_slots(spark)).collect()
    expected = []
    for team in (1, 2):
        for code in ("DFC", "POR"):
            here = sorted((r for r in rows if r[1] == team and r[3] == code), key=lambda r: (-(r[4] or 0.0), r[0]))
            expected += [(s["id_formacion"], s["slot"], team, here[s["slot_rank"] - 1][0]) for s in slots if s["posicion_xi"] == code and s["slot_rank"] <= len(here)]
    assert sorted((r["id_formacion"], r["slot"], r["id_equipo"], r["id_jugador"]) for r in seated.collect()) == sorted(expected) and len(expected) > 20
    plan = seated._jdf.queryExecution().optimizedPlan().toString()
    # The formations come in by one join, above the ranks.
    assert plan.count("Join") == 1 and plan.index("Join") < plan.index("dense_rank")


def test_squad_rows_of_a_name_move_together_and_nameless_ones_by_club(spark, shuffled):
    raw, catalog, players = squad_rows(spark)
    blank = [("Club A", "2020", None, "1"), ("Club A", "2020", None, "1"), ("Club A", "2020", "", "1"), ("Club B", "2020", None, "1"), (None, "2020", None, "1")]
    blank = spark.createDataFrame(blank, "club string, temporada string, jugador string, numero string")
    raw = raw.unionByName(raw).unionByName(blank, allowMissingColumns=True)
    ok, rejects = silver.squads(raw, catalog, players, None, F.lit("2024-01-01").cast("timestamp"))
    plan = ok._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_near" in plan and "hashpartitioning(club" not in plan
    assert sorted((r["id_equipo"], r["id_jugador"], r["numero_camiseta"]) for r in ok.collect()) == [(1, "p1", "8"), (1, "p2", "6"), (2, "p1", "9")]
    nameless = [(r["club"], r["jugador"], r["razon_rechazo"]) for r in rejects.collect() if not r["jugador"]]
    assert len(nameless) == 4 and set(nameless) == {
        (None, None, "SIN_MATCH_CATALOGO"), ("Club A", "", "SIN_MATCH_DIMENSION"), ("Club A", None, "SIN_MATCH_DIMENSION"), ("Club B", None, "SIN_MATCH_DIMENSION")}


def test_whole_tables_keep_their_order_and_keys_that_follow_are_not_written(spark, folder):
    rows = spark.createDataFrame([("a", 1, 2020), ("a", 1, 2021), ("b", None, 2020), (None, 2, None)], "id_jugador string, id_equipo int, temporada int").coalesce(1)
    tables = league.League(spark, folder)
    whole, cut = tables.stored("whole", lambda: rows, seasons=False), tables.stored("cut", lambda: rows)
    assert len(whole.inputFiles()) == 1 and whole.collect() == rows.collect()
    assert len(cut.inputFiles()) == 3 and all("temporada=" in f for f in cut.inputFiles())
    keyed = {(r["id_jugador"], r["id_equipo"], r["temporada"]): r["id_estadistica_jugador"] for r in gold.with_season_key(cut).collect()}
    expected = rows.withColumn("k", text.surrogate_key("id_jugador", "id_equipo", "temporada"))
    assert keyed == {(r["id_jugador"], r["id_equipo"], r["temporada"]): r["k"] for r in expected.collect()}


def test_scores_need_no_key_of_statistics_and_no_written_history(spark, folder, monkeypatch):
    """The hashed key of the statistics neither moves with them nor is stored with their features."""
    seen = []
    monkeypatch.setattr(scoring, "component_scores", lambda rows, **_: seen.append(rows.columns) or rows)
    monkeypatch.setattr(scoring, "cluster_levels", lambda rows, **_: rows.withColumn("score_ml", F.lit(1.0)))
    monkeypatch.setattr(scoring, "score_rows", lambda rows, as_of=None: rows)
    squads = spark.createDataFrame([("p1", 2020, 1, "b", "left", 1.8, "Portero")], "id_jugador string, temporada int, id_equipo int, id_plantilla_equipo string, pie string, altura double, posicion string")
    stats = spark.createDataFrame([("p1", 2020, 1, HEX)], "id_jugador string, temporada int, id_equipo int, id_estadistica_jugador string")
    stats = stats.withColumns({c: F.lit(1) for parts, _ in scoring.RATES.values() for c in parts}).withColumn("minutos_jugados", F.lit(900))
    assert [r["id_jugador"] for r in scoring.score_players(stats, squads).collect()] == ["p1"]
    assert "id_jugador" in seen[0] and "id_estadistica_jugador" not in seen[0]


def test_cell_lists_are_made_once_and_read_by_their_length(spark):
    cells = {15: ["", " Liga ", "30", "4", "1,5", "5", "6", "-", "8", "9", "10", "11", "12", "13", "1.014'"]}
    cells[16] = [*cells[15], "2,215"]
    rows = [(1, cells[15]), (2, cells[16]), (3, ["", "Copa", "7"]), (4, ["", "Copa"]), (5, ["", "12", "7"]), (6, ["", "1/2", "7"]), (7, ["", "", "7"]), (8, ["", None, "7"]), (9, None), (10, [])]
    df = spark.createDataFrame(rows, "id int, raw array<string>").select("id", F.array_append("raw", F.lit("hecho")).alias("c")).select("id", F.slice("c", 1, F.greatest(F.size("c") - 1, F.lit(0))).alias("c"))
    out = parsing.layout_by_arity(df, "c")
    found = {r["id"]: (r["competencia"], r["partidos_jugados"], r["ppp"], r["goles"], r["goles_en_contra"], r["minutos_jugados"]) for r in out.collect()}
    assert found == {1: ("Liga", 30, 1.5, 0, 12, 1014), 2: ("Liga", 30, 1.5, 5, 0, 2215), 3: ("Copa", 7, 0.0, 0, 0, 0)}
    # What the cells are made of stands in the plan once: a filter with copies of it made a method too long to compile.
    assert out._jdf.queryExecution().executedPlan().toString().count("hecho") == 1
