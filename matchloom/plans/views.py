"""Semantic views over the gold tables."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, fixed, measures, text
from ..operators import filters, joins, ranking, sets

ACCUMULATED = "Acumulado"
# The most slots a formation has for one eleven code.
MAX_SLOTS = max(Counter((f, code) for f, _, _, code, _, _ in fixed.SLOTS).values())

# Measures of a match that become one column per team; the source adds the side to the name.
TEAM_MATCH_MEASURES = [
    "pases", "pases_precisos", "regates_realizados", "saques_esquina", "gran_probabilidad", "tiros_area", "tiros_fuera_area",
    "tiros_bloqueados", "duelos_ganados", "entradas", "despejes", "bloqueos", "tarjetas_amarillas", "tarjetas_rojas",
    "fueras_juego", "paradas_portero", "tiros_largos_precisos", "tiros_libres_precisos", "grandes_oportunidades_perdidas",
    "toques_area_rival", "faltas", "centros_precisos", "mitad_propia", "mitad_rival", "lanzamientos",
]
TEAM_MATCH_SHARES = ["pases_precisos", "regates_realizados", "tiros_largos_precisos", "tiros_libres_precisos"]
INTERCEPTIONS = {"local": "intercepciones_local", "visitante": "interceptaciones_visitante"}


def general_performance(accumulated: DataFrame) -> DataFrame:
    return accumulated.drop("fecha_carga", "periodo").withColumn("tipo_tabla", F.lit(ACCUMULATED))


def seasons(*facts: DataFrame) -> DataFrame:
    return sets.union_distinct([f.select("temporada") for f in facts]).filter(F.col("temporada").isNotNull())


def table_types(season_performance: DataFrame) -> DataFrame:
    kinds = season_performance.select("tipo_tabla").distinct()
    tag = season_performance.sparkSession.range(1).select(F.lit(ACCUMULATED).alias("tipo_tabla"))
    return sets.union_distinct([kinds, tag])


def league_tables(season_performance: DataFrame, accumulated: DataFrame) -> DataFrame:
    """Tables of each tournament, and the accumulated table ranked per season."""
    detail = season_performance.select(
        F.col("id_clasificacion").alias("id_rendimiento"), "id_equipo", "nombre_equipo", "alias_equipo", "temporada",
        "tipo_tabla", "posicion", "partidos_jugados", "partidos_ganados", "partidos_empatados", "partidos_perdidos",
        "goles_favor", "goles_contra", "diferencia_goles", "puntos", "valor_total", "valor_medio",
        F.lit(None).cast("int").alias("torneos_disputados"))
    ranked = ranking.rank_table(general_performance(accumulated), ["temporada"], [
        ("total_puntos", "desc"), ("total_diferencia_goles", "desc"), ("total_goles_favor", "desc"), ("id_equipo", "asc")])
    names = {"id_acumulado": "id_rendimiento", "total_pj": "partidos_jugados", "total_pg": "partidos_ganados",
             "total_pe": "partidos_empatados", "total_pp": "partidos_perdidos", "total_goles_favor": "goles_favor",
             "total_goles_contra": "goles_contra", "total_diferencia_goles": "diferencia_goles", "total_puntos": "puntos"}
    return detail.unionByName(ranked.withColumnsRenamed(names))


def _side(side: str, other: str) -> dict[str, Column]:
    scored, conceded = F.col(f"goles_{side}"), F.col(f"goles_{other}")
    shots = F.col(f"tiros_totales_{side}")
    return {
        "id_equipo": F.col(f"id_equipo_{side}"), "nombre_equipo": F.col(f"nombre_equipo_{side}"),
        "alias_equipo": F.col(f"alias_equipo_{side}"), "id_rival": F.col(f"id_equipo_{other}"),
        "goles_favor": scored, "goles_contra": conceded, "diferencia_goles": scored - conceded,
        "resultado": measures.result_code(scored, conceded, "marcador"),
        "posesion_pct": F.col(f"posesion_{side}_pct"), "tiros_totales": shots,
        "disparos_puerta": F.col(f"disparos_puerta_{side}"),
        "precision_tiro_pct": measures.ratio4(F.col(f"disparos_puerta_{side}"), shots),
        "conversion_gol_pct": measures.ratio4(scored, shots),
        **{m: F.col(f"{m}_{side}") for m in TEAM_MATCH_MEASURES},
        **{f"{m}_pct": F.col(f"{m}_{side}_pct") for m in TEAM_MATCH_SHARES},
        "intercepciones": F.col(INTERCEPTIONS[side]),
    }


def team_matches(detail: DataFrame) -> DataFrame:
    """Two rows per match, one for each team, from one scan."""
    tagged = detail.withColumn("partido_sin_info", measures.score_missing("marcador")).withColumn(
        "estado_partido", measures.match_status("marcador"))
    keep = ["id_partido", "temporada", "fecha_partido", "estado", "fecha_stats", "partido_sin_info", "estado_partido",
            "url", "fuente_partido"]
    return sets.unpivot_roles(tagged, keep, {"LOCAL": _side("local", "visitante"), "VISITANTE": _side("visitante", "local")},
                              "rol_equipo")


def player_season_view(stats: DataFrame) -> DataFrame:
    return (filters.only_true(stats, "datos_disponibles").drop("nacionalidad_principal", "fecha_carga", "periodo")
            .withColumnRenamed("tarjeta_amarilla_roja", "segunda_amarilla")
            .withColumn("posicion_xi", text.xi_code("posicion")))


def formations(spark: SparkSession) -> DataFrame:
    rows = [(i, f, s, f"{f} - {s}") for i, f, s in fixed.FORMATIONS]
    return spark.createDataFrame(rows, "id_formacion int, formacion string, estilo string, formacion_display string")


def styles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.STYLES, "id_estilo int, estilo string")


def formation_slots(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fixed.SLOTS, "id_formacion int, slot string, orden int, posicion_xi string, x_coord int, y_coord int")


def players_per_slot(stats_view: DataFrame) -> DataFrame:
    """Every slot of the formations with the number of different players of its position.

    Players are told apart and counted per position before they meet the slots: the slots are the side that a left join keeps, so the
    rows of a position could neither stay where they are nor be split, and there are few positions."""
    person = text.packed_key("id_jugador").alias("_player")
    players = stats_view.select("posicion_xi", person).distinct().groupBy("posicion_xi").agg(F.count("_player").alias("jugadores"))
    return formation_slots(stats_view.sparkSession).join(players, "posicion_xi", "left").withColumn("jugadores", F.coalesce("jugadores", F.lit(0)))


def squad_history_view(history: DataFrame) -> DataFrame:
    """Adds the age in the season; the clock is the load time of the row."""
    aged = history.withColumn("edad_historica", dates.historical_age("edad", "fecha_carga", "temporada"))
    return aged.withColumnRenamed("edad", "edad_actual").select(
        "id_plantilla_equipo", "id_equipo", "nombre_equipo", "alias_equipo", "id_jugador", "jugador", "temporada",
        "numero_camiseta", "posicion", "fecha_fichaje", "edad_actual", "edad_historica", "nacionalidad_principal",
        "segunda_nacionalidad", "altura", "pie", "valor_mercado")


def _seated(players: DataFrame, order: ranking.Order) -> DataFrame:
    """Players of a team and season in the slots of every formation (a fixed table of 88). Their rank at a position is the same in
    all formations, so it is found once, before the rows are repeated for each slot."""
    ranked = ranking.dense_rank_in(players, ["temporada", "posicion_xi", "id_equipo"], order, MAX_SLOTS, "player_rank")
    numbered = F.broadcast(ranking.number_slots(formation_slots(ranked.sparkSession)))
    seated = joins.assign_slots(ranked, numbered, ["posicion_xi"])
    first = ["id_formacion", "posicion_xi"]
    return seated.select(*first, *[c for c in seated.columns if c not in (*first, "player_rank")])


def weighted_eleven(stats_view: DataFrame, squad_view: DataFrame, min_games: int = 5) -> DataFrame:
    """Best players of each team per formation slot by the hand-weighted score."""
    profile = squad_view.select("id_jugador", "temporada", "id_equipo", "altura", "pie", "valor_mercado",
                                "edad_historica", "nacionalidad_principal")
    base = joins.join_keys(filters.at_least(stats_view, "partidos_jugados", min_games), profile,
                           ["id_jugador", "temporada", "id_equipo"])
    scored = base.withColumn("score", measures.xi_score("posicion_xi"))
    return _seated(scored, [("score", "desc"), ("id_jugador", "asc")])


def scored_eleven(score: DataFrame) -> DataFrame:
    """Model scores, rounded, with the slot each player takes in every formation."""
    rounded = {"goles_p90": 3, "asistencias_p90": 3, "participacion_p90": 3, "gc_p90": 3, "pi_p90": 3,
               "score_ml": 4, "score_100": 2}
    shown = score.withColumnsRenamed({"tarjeta_amarilla_roja": "segunda_amarilla"})
    for c, digits in rounded.items():
        shown = shown.withColumn(c, F.round(c, digits))
    shown = (shown.withColumn("varianza_explicada_pct", F.round(F.col("var_explicada") * 100, 1))
             .withColumn("posicion_xi_nombre", text.map_label("posicion_xi", fixed.XI_NAMES, "posicion_xi"))
             .withColumn("participaciones_gol", F.col("goles") + F.col("asistencias"))
             .drop("var_explicada", "amarillas_p90", "rojas_p90", "segunda_am_p90", "fecha_carga", "periodo"))
    return _seated(shown, [("score_100", "desc"), ("id_jugador", "asc")])


def eleven_seasons(score: DataFrame) -> DataFrame:
    """The seasons of `scored_eleven(score)`: the first player of a team at a position has a slot in every formation that has the
    position, so no rank is needed to tell them."""
    return score.filter(F.col("posicion_xi").isin(sorted({code for _, _, _, code, _, _ in fixed.SLOTS}))).select("temporada")


def calendar(df: DataFrame, col: str) -> DataFrame:
    """Every day between the first and the last date of the column."""
    ends = df.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
    days = ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("fecha"))
    return days.select("fecha", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"), F.dayofmonth("fecha").alias("dia"))
