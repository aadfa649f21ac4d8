"""Star-schema facts and the team dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures, text
from ..operators import aggregates, joins, ranking, shape
from ..session import dealt

MATCH_COLUMNS_IN_STATS = ["id_equipo_local", "id_equipo_visitante", "temporada", "marcador", "goles_local",
                          "goles_visitante", "url", "fuente", "periodo", "fecha_carga"]

# Statistics and squad rows that a task brings together.
ROWS_A_TASK = 250_000


def _now(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def _team(dim: DataFrame) -> DataFrame:
    return dim.select("id_equipo", "nombre_equipo", "alias_equipo")


def team_dimension(catalog: DataFrame, teams: DataFrame, stadiums: DataFrame, values: DataFrame,
                   as_of: Column | None = None) -> DataFrame:
    newest = ranking.latest_per_key(values, ["id_equipo"], [("temporada", "desc")]).select(
        "id_equipo", F.col("valor_total").alias("valor_total_actual"), F.col("valor_medio").alias("valor_medio_actual"),
        F.col("jugadores_en_plantilla").alias("jugadores_plantilla_actual"),
        F.col("edad_promedio").alias("edad_promedio_actual"), F.col("extranjeros").alias("extranjeros_actual"),
        F.col("temporada").alias("temporada_ultima_valoracion"))
    ground = ranking.latest_per_key(stadiums, ["id_equipo"], [("fecha_carga", "desc"), ("id_estadio", "asc")]).select(
        "id_equipo", "estadio", "capacidad", "aforo")
    base = catalog.select("id_equipo", "nombre_equipo")
    names = teams.select("id_equipo", "alias_equipo", "url_equipo")
    return (joins.star_join(base, [(names, ["id_equipo"]), (ground, ["id_equipo"]), (newest, ["id_equipo"])])
            .withColumn("fecha_carga", _now(as_of)))


def season_performance(standings: DataFrame, values: DataFrame, dim: DataFrame, as_of: Column | None = None) -> DataFrame:
    money = values.select("id_equipo", "temporada", "valor_total", "valor_medio")
    fact = standings.drop("fecha_carga")
    joined = joins.star_join(fact, [(money, ["id_equipo", "temporada"]), (_team(dim), ["id_equipo"])])
    return joined.select(
        "id_clasificacion", "id_equipo", "nombre_equipo", "alias_equipo", "temporada", "tipo_tabla", "posicion",
        "partidos_jugados", "partidos_ganados", "partidos_empatados", "partidos_perdidos", "goles_favor", "goles_contra",
        "diferencia_goles", "puntos", "valor_total", "valor_medio", _now(as_of).alias("fecha_carga"), "periodo")


def accumulated_performance(standings: DataFrame, values: DataFrame, dim: DataFrame,
                            as_of: Column | None = None) -> DataFrame:
    totals = aggregates.season_totals(standings)
    money = aggregates.max_per_key(values, ["id_equipo", "temporada"], ["valor_total", "valor_medio"])
    joined = joins.star_join(totals, [(money, ["id_equipo", "temporada"]), (_team(dim), ["id_equipo"])])
    whole = ["torneos_disputados", "total_pj", "total_pg", "total_pe", "total_pp", "total_goles_favor",
             "total_goles_contra", "total_diferencia_goles", "total_puntos"]
    return joined.select(
        text.surrogate_key("id_equipo", "temporada").alias("id_acumulado"), "id_equipo", "nombre_equipo", "alias_equipo",
        "temporada", *[F.col(c).cast("int").alias(c) for c in whole], "valor_total", "valor_medio",
        _now(as_of).alias("fecha_carga"), F.col("temporada").alias("periodo"))


def match_detail(matches: DataFrame, stats: DataFrame, dim: DataFrame, as_of: Column | None = None) -> DataFrame:
    extra = shape.project_excluding(stats, MATCH_COLUMNS_IN_STATS)
    joined = joins.join_keys(matches.drop("fecha_carga"), extra, ["id_partido"])
    named = joins.join_roles(joined, _team(dim), "id_equipo", {
        f"id_equipo_{side}": {"nombre_equipo": f"nombre_equipo_{side}", "alias_equipo": f"alias_equipo_{side}"}
        for side in ("local", "visitante")})
    measured = [c for c in extra.columns if c != "id_partido"]
    return named.select(
        "id_partido", "id_equipo_local", "nombre_equipo_local", "alias_equipo_local", "id_equipo_visitante",
        "nombre_equipo_visitante", "alias_equipo_visitante", "temporada", "fecha_partido", "marcador", "goles_local",
        "goles_visitante", *measured, "url", "fuente_partido", _now(as_of).alias("fecha_carga"), "periodo")


def squad_history(squads: DataFrame, players: DataFrame, dim: DataFrame, as_of: Column | None = None) -> DataFrame:
    profile = players.select("id_jugador", "jugador", "edad", "nacionalidad_principal", "segunda_nacionalidad", "altura",
                             "pie", "valor_mercado", "foto_url")
    # The hashes of the rows travel as bytes.
    fact = squads.drop("fecha_carga").withColumns({c: text.packed_key(c) for c in ("id_jugador", "id_plantilla_equipo")})
    profile = profile.withColumn("id_jugador", text.packed_key("id_jugador"))
    joined = joins.join_keys(joins.join_keys(fact, profile, ["id_jugador"], "inner"), _team(dim), ["id_equipo"])
    return joined.select(
        text.unpacked_key("id_plantilla_equipo").alias("id_plantilla_equipo"), "id_equipo", "nombre_equipo", "alias_equipo",
        text.unpacked_key("id_jugador").alias("id_jugador"), "id_tm", "jugador", "temporada",
        "numero_camiseta", "posicion", "fecha_fichaje", "edad", "nacionalidad_principal", "segunda_nacionalidad", "altura",
        "pie", "valor_mercado", "foto_url", _now(as_of).alias("fecha_carga"), "periodo")


def coach_history(spells: DataFrame, coaches: DataFrame, dim: DataFrame, as_of: Column | None = None) -> DataFrame:
    profile = coaches.select("id_entrenador", "entrenador", "edad", "nacionalidad_principal", "segunda_nacionalidad")
    fact = spells.drop("fecha_carga")
    joined = joins.join_keys(joins.join_keys(fact, profile, ["id_entrenador"], "inner"), _team(dim), ["id_equipo"])
    return joined.select(
        "id_entrenador_equipo", "id_equipo", "nombre_equipo", "alias_equipo", "id_entrenador", "entrenador", "edad",
        "nacionalidad_principal", "segunda_nacionalidad", "temporada", "fecha_inicio", "fecha_termino", "tiempo_en_cargo",
        "partidos", "ppp", "entrenador_activo", _now(as_of).alias("fecha_carga"), "periodo")


def value_history(values: DataFrame, dim: DataFrame, as_of: Column | None = None) -> DataFrame:
    joined = joins.join_keys(values.drop("fecha_carga"), _team(dim), ["id_equipo"])
    return joined.select(
        "id_valoracion_equipo", "id_equipo", "nombre_equipo", "alias_equipo", "temporada", "jugadores_en_plantilla",
        "edad_promedio", "extranjeros", "valor_medio", "valor_total", _now(as_of).alias("fecha_carga"), "periodo")


def with_season_key(df: DataFrame) -> DataFrame:
    """Season statistics with their hashed key, which follows from the player, team and season of the row."""
    return df.select(text.surrogate_key("id_jugador", "id_equipo", "temporada").alias("id_estadistica_jugador"), *df.columns)


def player_season_stats(stats: DataFrame, players: DataFrame, squads: DataFrame, dim: DataFrame,
                        as_of: Column | None = None, tasks: int | None = None) -> DataFrame:
    """Totals of all competitions per player, team and season. Rows are dealt to `tasks` tasks, else they are counted first."""
    profile = players.select(text.packed_key("id_jugador").alias("id_jugador"), "foto_url", "nacionalidad_principal")
    # Statistics and squad rows go once to the partition of their player, whose totals, positions and profile meet there.
    keys = ["id_jugador", "id_tm", "jugador", "id_equipo", "temporada", "periodo", "_squad", "posicion"]
    counted = [*aggregates.PLAYER_MEASURES, "ppp", "goles", "penaltis_anotados", "datos_disponibles"]
    places = squads.select("id_jugador", "id_equipo", "temporada", "posicion", F.lit(True).alias("_squad"))
    rows = stats.select(*keys[:-2], *counted, F.lit(False).alias("_squad")).unionByName(places, allowMissingColumns=True)
    rows = rows.filter(F.col("id_jugador").isNotNull()).withColumn("id_jugador", text.packed_key("id_jugador"))
    rows = rows.repartition(tasks, "id_jugador") if tasks else dealt(rows, ROWS_A_TASK, "id_jugador")
    totals = aggregates.player_totals(rows, keys)
    place = F.max("posicion").over(Window.partitionBy("id_jugador", "id_equipo", "temporada"))
    known = F.col("id_equipo").isNotNull() & F.col("temporada").isNotNull()
    totals = totals.withColumn("posicion", F.when(known, place)).filter(~F.col("_squad")).drop("_squad")
    joined = joins.star_join(joins.join_keys(totals, profile, ["id_jugador"], "inner"), [(_team(dim), ["id_equipo"])])
    joined = joined.withColumn("id_jugador", text.unpacked_key("id_jugador"))
    whole = [*aggregates.PLAYER_MEASURES, "goles"]
    typed = joined.select(*[F.col(c).cast("int").alias(c) if c in whole else F.col(c) for c in joined.columns])
    return with_season_key(typed.select(
        "id_jugador", "id_tm", "jugador", "foto_url", "id_equipo", "nombre_equipo", "alias_equipo", "temporada", "partidos_jugados", "titularidades",
        "ppp", "goles", "asistencias", "tarjetas_amarillas", "tarjeta_amarilla_roja", "tarjetas_rojas", "entrada_suplente",
        "salida_suplente", "goles_en_contra", "partidos_imbatido",
        measures.minutes_per_goal("minutos_jugados", "goles").alias("min_por_gol"), "minutos_jugados", "datos_disponibles",
        "posicion", "nacionalidad_principal", _now(as_of).alias("fecha_carga"), "periodo"))
