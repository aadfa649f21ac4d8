"""Silver, gold, views and questions over league entities derived from the whole supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions import text
from matchloom.operators import sets
from matchloom.plans import bronze, questions as Q, scoring, silver, views
from matchloom.session import scratch_dir
from matchloom.sources import writers

from .league import League, padded, txt
from .oracle import PLACES, SHARE_VALUES, STAT_VALUES
from .registry import league_query, query, table


def dated(columns: str, name: str, *dates: str, flags: tuple[str, ...] = ()) -> str:
    casts = [f"CAST({d} AS VARCHAR) AS {d}" for d in dates] + [f"CAST({f} AS INT) AS {f}" for f in flags]
    return f"SELECT {columns} REPLACE ({', '.join(casts)}) FROM {name}" if casts else f"SELECT {columns} FROM {name}"


# ---- bronze --------------------------------------------------------------------------------


@query("R01_curate_json", """SELECT 'https://m/' || o_orderkey AS url, '[{"local":"' || o_orderstatus || '"}]' AS data, 'desconocido' AS fuente, '2024' AS temporada FROM orders""")
def _(s, sf):
    rows = table(s, sf, "orders").select(txt("https://m/", F.col("o_orderkey")).alias("url"), F.array(F.struct(F.col("o_orderstatus").alias("local"))).alias("data"))
    return bronze.curate_json(rows, 2024, F.lit("2024-06-30").cast("timestamp"))


@query("R02_curate_csv", "SELECT lower(c_name) AS nombre_unico, lower(c_mktsegment) AS segmento FROM customer")
def _(s, sf):
    rows = table(s, sf, "customer").select(txt(" ", F.col("c_name"), " ").alias("Nombre Único"), F.col("c_mktsegment").alias("Segmento"))
    return bronze.curate_csv(rows)


@query("R03_curate_catalog", "SELECT lower(s_name) AS equipo, 'club nandu ' || s_suppkey AS alias FROM supplier")
def _(s, sf):
    rows = table(s, sf, "supplier").select(F.col("s_name").alias("Equipo"), txt("Club Ñandú ", F.col("s_suppkey")).alias("Alias"))
    return bronze.curate_catalog(rows)


@query("R04_unify_history", """SELECT CAST(year(o_orderdate) AS INT) AS y, count(*) AS n, count(CASE WHEN year(o_orderdate) >= 1997 THEN o_orderstatus END) AS extra FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1999 GROUP BY 1""")
def _(s, sf):
    base = scratch_dir(s)
    o = table(s, sf, "orders").withColumn("y", F.year("o_orderdate"))
    for y in range(1995, 2000):
        cols = ["o_orderkey", "y"] + (["o_orderstatus"] if y >= 1997 else [])
        o.filter(F.col("y") == y).select(*cols).write.parquet(f"{base}/stg/{y}/curated")
    all_years = bronze.unify_history(s, base, 1994, 2000)
    return all_years.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.count("o_orderstatus").alias("extra"))


# ---- silver --------------------------------------------------------------------------------

league_query("B01_md_catalogo_equipos", "SELECT * FROM cat")(lambda L: L.catalog)
league_query("B02_md_equipos", "SELECT * FROM md_equipos")(lambda L: L.teams_split[0])
league_query("B03_md_estadios", "SELECT * FROM md_estadios")(lambda L: L.stadiums_split[0])
league_query("B03_md_estadios_rechazos", "SELECT CASE WHEN s_acctbal < 1000 THEN 'SIN_MATCH_CATALOGO' ELSE 'REGLA_NEGOCIO' END AS razon_rechazo, count(*) AS n FROM supplier WHERE s_acctbal < 1000 OR s_acctbal > 9000 GROUP BY 1")(
    lambda L: L.stadiums_split[1].groupBy("razon_rechazo").agg(F.count(F.lit(1)).alias("n")))
league_query("B04_md_plantillas", "SELECT * EXCLUDE (l_partkey, p_size) FROM md_plantillas")(lambda L: L.players)
league_query("B05_hm_plantillas_equipo", dated("*", "hm_plantillas", "fecha_fichaje"))(lambda L: L.squads_split[0])
league_query("B05_hm_plantillas_rechazos", "SELECT 'SIN_MATCH_CATALOGO' AS razon_rechazo, 'Club Supplier ' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS club, count(*) AS n FROM sb WHERE l_suppkey NOT IN (SELECT s_suppkey FROM known) GROUP BY 2")(
    lambda L: L.squads_split[1].groupBy("razon_rechazo", "club").agg(F.count(F.lit(1)).alias("n")))
league_query("B06_md_entrenadores", "SELECT * EXCLUDE (o_custkey) FROM md_entrenadores")(lambda L: L.coaches)
league_query("B07_hm_entrenadores_equipo", dated("*", "hm_entrenadores", "fecha_inicio", "fecha_termino"))(lambda L: L.spells_split[0])
league_query("B08_hm_valoracion_equipos", "SELECT * FROM hm_valor")(lambda L: L.values_split[0])
league_query("B09_hm_partidos", dated("* EXCLUDE (q, gl, gv, o_orderstatus)", "hm_partidos", "fecha_partido"))(lambda L: L.matches_split[0])
league_query("B10_hm_estadisticas_partidos", dated("*", "hm_stats", "fecha_stats"))(
    lambda L: L.match_stats.select("id_partido", "id_equipo_local", "id_equipo_visitante", "temporada", "marcador", "goles_local", "goles_visitante", "url",
                                   "fecha_stats", *STAT_VALUES, *SHARE_VALUES, "fuente", "periodo"))
league_query("B11_hm_tablas_clasificacion", "SELECT * FROM hm_tablas")(lambda L: L.standings_split[0])
league_query("B12_hm_campeones", "SELECT * FROM hm_campeones")(lambda L: L.champions)
league_query("B13_hm_estadisticas_jugadores", dated("*", "hm_jugadores", flags=("datos_disponibles",)))(lambda L: L.player_stats_split[0])
league_query("B13_rechazos_jugadores", """SELECT CASE WHEN l_suppkey IN (SELECT s_suppkey FROM known) THEN 'SIN_MATCH_MD_PLANTILLAS' ELSE 'SIN_MATCH_CATALOGO' END AS razon_rechazo, count(*) AS n
    FROM psb JOIN md_plantillas USING (l_partkey) WHERE p_size = 50 OR l_suppkey NOT IN (SELECT s_suppkey FROM known) GROUP BY 1""")(
    lambda L: L.player_stats_split[1].groupBy("razon_rechazo").agg(F.count(F.lit(1)).alias("n")))


@league_query("B14_fix_md_plantillas", """SELECT lower(jugador) AS jugador, 'zurdo' AS pie, CASE WHEN l_partkey % 2 = 0 THEN 1.9::DOUBLE END AS altura, CASE WHEN l_partkey % 3 = 0 THEN 5000.0::DOUBLE END AS valor_mercado FROM md_plantillas WHERE l_partkey IN (SELECT l_partkey FROM sb)""")
def _(L: League):
    last = L.raw_squads.select(txt(" ", F.upper("jugador")).alias("jugador"), "temporada", F.lit(" zurdo ").alias("pie"),
                               F.when(F.regexp_extract("jugador", r"(\d+)$", 1).cast("int") % 2 == 0, "1,90 m").otherwise("-").alias("altura"),
                               F.when(F.regexp_extract("jugador", r"(\d+)$", 1).cast("int") % 3 == 0, "5 mil €").otherwise("0,0").alias("valor_mercado"))
    return silver.patch_players(last)


@league_query("B14_patch_applied", "SELECT id_jugador, CASE WHEN l_partkey % 2 = 0 THEN 1.9::DOUBLE ELSE altura END AS altura, CASE WHEN pie = 'left' THEN 'zurdo' ELSE pie END AS pie FROM md_plantillas")
def _(L: League):
    number = F.regexp_extract("jugador", r"(\d+)$", 1).cast("int")
    raw = L.tb_players.select("jugador", F.lit("2024").alias("temporada"), F.when(F.col("pie") == "left", "zurdo").alias("pie"),
                           F.when(number % 2 == 0, "1,90 m").alias("altura"), F.lit(None).cast("string").alias("valor_mercado"))
    fixed_rows = writers.merge_update_only(L.tb_players, silver.patch_players(raw), text.join_name("jugador"), "jugador")
    return fixed_rows.select("id_jugador", "altura", "pie")


_FIX_PLACE = "[" + ", ".join(f"'{p}'" for p in PLACES) + "][CAST(s.p_size % 13 AS INT) + 1]"


@league_query("B15_fix_hm_plantillas", f"""SELECT sha256(l_suppkey || '-' || m.id_jugador || '-' || season || '-' || lower({_FIX_PLACE})) AS id_plantilla_equipo, CAST(l_suppkey AS INT) AS id_equipo, m.id_jugador,
    season AS temporada, CAST(number AS VARCHAR) AS numero_camiseta, {_FIX_PLACE} AS posicion, CAST(CAST(signed AS DATE) AS VARCHAR) AS fecha_fichaje FROM sb s JOIN md_plantillas m USING (l_partkey)
    WHERE l_suppkey IN (SELECT s_suppkey FROM known)""")
def _(L: League):
    kept, _rejects = silver.patch_squads(L.raw_squads, L.tb_catalog, L.tb_players, L.as_of, L.squad_tasks)
    return kept.select("id_plantilla_equipo", "id_equipo", "id_jugador", "temporada", "numero_camiseta", "posicion", "fecha_fichaje")


@league_query("B16_fix_estadisticas_partidos", "SELECT id_partido, CAST(fecha_stats AS VARCHAR) AS fecha_stats, goles_local, pases_local, 0 AS faltas_local, 0.0::DOUBLE AS duelo_terrestre_local_pct FROM hm_stats")
def _(L: League):
    raw = L.raw_match_stats.drop("fecha").join(L.raw_matches.select("url", "fecha"), "url")
    out = silver.patch_match_stats(raw, L.tb_matches, L.as_of)
    return out.select("id_partido", "fecha_stats", "goles_local", "pases_local", "faltas_local", "duelo_terrestre_local_pct")


# ---- gold ------------------------------------------------------------------------------------

league_query("G1_dm_equipos", "SELECT * FROM dim")(lambda L: L.dim)
league_query("G2_ft_rendimiento_temporada", "SELECT * FROM ft_temporada")(lambda L: L.season_performance)
league_query("G3_ft_rendimiento_acumulado", "SELECT * FROM ft_acumulado")(lambda L: L.accumulated)
league_query("G4_ft_partidos_detalle", dated("*", "ft_detalle", "fecha_partido", "fecha_stats"))(
    lambda L: L.match_detail.select("id_partido", "id_equipo_local", "nombre_equipo_local", "alias_equipo_local", "id_equipo_visitante", "nombre_equipo_visitante",
                                    "alias_equipo_visitante", "temporada", "fecha_partido", "marcador", "goles_local", "goles_visitante", "fecha_stats",
                                    *STAT_VALUES, *SHARE_VALUES, "url", "fuente_partido", "periodo"))
league_query("G5_ft_plantillas_historico", dated("*", "ft_plantillas", "fecha_fichaje"))(lambda L: L.squad_history)
league_query("G6_ft_entrenadores_historico", dated("*", "ft_entrenadores", "fecha_inicio", "fecha_termino"))(lambda L: L.coach_history)
league_query("G7_ft_evolucion_valoracion", "SELECT * FROM ft_valor")(lambda L: L.value_history)
league_query("G8_ft_estadisticas_jugadores", dated("*", "(SELECT * REPLACE (round(ppp, 6) AS ppp) FROM ft_jugadores)", flags=("datos_disponibles",)))(
    lambda L: L.player_season_stats.withColumn("ppp", F.round("ppp", 6)))

# ---- views -----------------------------------------------------------------------------------

league_query("V01_rendimiento_general", "SELECT * EXCLUDE (periodo), 'Acumulado' AS tipo_tabla FROM ft_acumulado")(lambda L: views.general_performance(L.tb_accumulated))
league_query("V02_temporadas", "SELECT temporada FROM ft_detalle UNION SELECT temporada FROM ft_temporada UNION SELECT temporada FROM ft_acumulado")(
    lambda L: views.seasons(L.tb_match_detail, L.tb_season_performance, L.tb_accumulated))
league_query("V03_tipos_de_tabla", "SELECT tipo_tabla FROM ft_temporada UNION SELECT 'Acumulado'")(lambda L: views.table_types(L.tb_season_performance))
league_query("V04_posiciones", "SELECT * FROM posiciones")(lambda L: L.tables)
league_query("V05_partidos_equipo", dated("*", "partidos_equipo", "fecha_partido", "fecha_stats"))(
    lambda L: L.team_matches.select("id_partido", "temporada", "fecha_partido", "fecha_stats", "partido_sin_info", "estado_partido", "url", "fuente_partido", "rol_equipo",
                                    "id_equipo", "nombre_equipo", "alias_equipo", "id_rival", "goles_favor", "goles_contra", "diferencia_goles", "resultado", "posesion_pct",
                                    "tiros_totales", "disparos_puerta", "precision_tiro_pct", "conversion_gol_pct", "pases", "pases_precisos", "tarjetas_amarillas",
                                    "duelos_ganados", "entradas", "regates_realizados", "pases_precisos_pct"))
league_query("V06_estadisticas_jugadores", dated("*", "(SELECT * REPLACE (round(ppp, 6) AS ppp) FROM stats_vw)", flags=("datos_disponibles",)))(
    lambda L: L.stats_view.withColumn("ppp", F.round("ppp", 6)))
league_query("V07_formaciones_con_jugadores", """SELECT s.id_formacion, s.slot, s.orden, s.x_coord, s.y_coord, s.posicion_xi, count(DISTINCT v.id_jugador) AS jugadores FROM slots s
    LEFT JOIN stats_vw v USING (posicion_xi) GROUP BY ALL""")(
    lambda L: views.players_per_slot(L.stats_view).select("id_formacion", "slot", "orden", "x_coord", "y_coord", "posicion_xi", "jugadores"))

_W = {"DC": (8, 3, 100, .5, 1, 2, True), "EI": (6, 5, 100, .5, 1, 2, True), "ED": (6, 5, 100, .5, 1, 2, True), "MCO": (5, 6, 100, .3, 1.5, 1.5, True), "MC": (3, 4, 100, .3, 1.5, 1.5, True),
      "MCD": (2, 3, 100, .3, 2, 1.5, False), "DFC": (0, 0, 80, .3, 2, 1, False), "LD": (0, 2, 90, .3, 1.5, 1, False), "LI": (0, 2, 90, .3, 1.5, 1, False)}
_B = {"DC": (10, 6, 3), "EI": (8, 5, 2), "ED": (8, 5, 2), "MCO": (5, 3, 1), "MC": (3, 2, 1)}


def _xi_sql() -> str:
    out = "CASE posicion_xi"
    for code, (g, a, d, pj, ta, ppp, _bonus) in _W.items():
        out += (f" WHEN '{code}' THEN goles * {g}.0 + asistencias * {a}.0 + minutos_jugados / {d}.0 + partidos_jugados * {pj} + titularidades * 1.5 - tarjetas_amarillas * {ta} - segunda_amarilla * 3.0"
                f" - tarjetas_rojas * 5.0 - salida_suplente * 0.5 - entrada_suplente * 0.3 + ppp * {ppp}")
        if code in _B:
            b = _B[code]
            out += f" + CASE WHEN min_por_gol > 0 AND min_por_gol <= 90 THEN {b[0]} WHEN min_por_gol > 90 AND min_por_gol <= 130 THEN {b[1]} WHEN min_por_gol > 130 AND min_por_gol <= 180 THEN {b[2]} ELSE 0 END"
    return out + (" WHEN 'POR' THEN minutos_jugados / 70.0 + partidos_jugados * 0.3 + titularidades * 1.5 - tarjetas_amarillas * 2.0 - segunda_amarilla * 3.0 - tarjetas_rojas * 5.0 + ppp * 1.5"
                  " + partidos_imbatido * 2.0 - goles_en_contra * 0.5 ELSE 0 END")


league_query("V08_once_ponderado", f"""SELECT id_jugador, id_equipo, temporada, r.id_formacion, slot, orden, x_coord, y_coord, round(score, 6)::DOUBLE AS score, altura, pie, valor_mercado, edad_historica FROM (
    SELECT *, dense_rank() OVER (PARTITION BY temporada, id_formacion, posicion_xi, id_equipo ORDER BY round(score, 9) DESC, id_jugador) AS player_rank FROM (
    SELECT e.*, f.id_formacion, p.altura, p.pie, p.valor_mercado, p.edad_historica, CAST({_xi_sql()} AS DOUBLE) AS score FROM stats_vw e LEFT JOIN plantillas_vw p USING (id_jugador, temporada, id_equipo)
    JOIN (SELECT DISTINCT id_formacion, posicion_xi FROM slots) f USING (posicion_xi) WHERE partidos_jugados >= 5)) r
    JOIN slot_ranks s ON s.id_formacion = r.id_formacion AND s.posicion_xi = r.posicion_xi AND s.slot_rank = r.player_rank""")(
    lambda L: views.weighted_eleven(L.stats_view, views.squad_history_view(L.squad_history)).select(
        "id_jugador", "id_equipo", "temporada", "id_formacion", "slot", "orden", "x_coord", "y_coord", F.round("score", 6).alias("score"), "altura", "pie", "valor_mercado", "edad_historica"))
league_query("V09_score_vista", "SELECT * REPLACE (round(ppp, 6) AS ppp) FROM score_vw")(lambda L: L.score_view.withColumn("ppp", F.round("ppp", 6)))
league_query("V10_plantillas_vista", dated("*", "plantillas_vw", "fecha_fichaje"))(lambda L: L.squad_view)


@query("V11_calendario", """SELECT CAST(CAST(f AS DATE) AS VARCHAR) AS fecha, CAST(year(f) AS INT) AS anio, CAST(month(f) AS INT) AS mes, CAST(day(f) AS INT) AS dia FROM
    (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS f FROM orders)""")
def _(s, sf):
    return views.calendar(table(s, sf, "orders"), "o_orderdate")


# ---- questions -----------------------------------------------------------------------------

T = ", ".join(Q.TABLE_COLUMNS)
ACC = "lower(tipo_tabla) = 'acumulado' AND partidos_jugados > 0"
league_query("Q01_tabla_posiciones", f"SELECT {T} FROM posiciones WHERE {ACC} AND temporada = (SELECT max(temporada) FROM posiciones WHERE {ACC}) ORDER BY posicion, nombre_equipo")(
    lambda L: Q.league_table(L.tables))
league_query("Q01_tabla_sin_acumulado", f"SELECT {T} FROM posiciones WHERE tipo_tabla = 'Apertura' AND partidos_jugados > 0 AND temporada = 1997 ORDER BY posicion, nombre_equipo")(
    lambda L: Q.league_table(L.tables.filter("tipo_tabla <> 'Acumulado'"), 1997))
league_query("Q02_clasificacion_historica", f"SELECT {T} FROM posiciones WHERE lower(tipo_tabla) LIKE '%clausura%' AND partidos_jugados > 0 AND temporada = 1998 ORDER BY posicion, tipo_tabla, nombre_equipo")(
    lambda L: Q.past_table(L.tables, 1998, "Clausura"))
league_query("Q03_eficiencia_historica", f"""SELECT nombre_equipo, round(sum(puntos) / sum(partidos_jugados), 2) AS ppp_historico, CAST(sum(puntos) AS BIGINT) AS puntos_totales, count(DISTINCT temporada) AS temporadas,
    CAST(sum(partidos_ganados) AS BIGINT) AS victorias_totales, CAST(sum(partidos_jugados) AS BIGINT) AS partidos_totales FROM posiciones WHERE {ACC} GROUP BY 1 ORDER BY ppp_historico DESC, nombre_equipo LIMIT 15""")(
    lambda L: Q.historic_efficiency(L.tables))
league_query("Q04_carrera_titulo", f"""SELECT nombre_equipo, temporada, puntos, posicion FROM posiciones WHERE {ACC} AND nombre_equipo IN (SELECT nombre_equipo FROM posiciones WHERE {ACC} GROUP BY 1
    ORDER BY sum(puntos) DESC, nombre_equipo LIMIT 5)""")(lambda L: Q.title_race(L.tables, 5))
league_query("Q05_evolucion_puntos", f"SELECT {T} FROM posiciones WHERE {ACC} AND (nombre_equipo LIKE '%00003%' OR nombre_equipo LIKE '%00005%')")(
    lambda L: Q.points_history(L.tables, ["00003", "00005"]))
league_query("Q06_gep_equipo", f"""SELECT nombre_equipo, CAST(sum(partidos_ganados) AS BIGINT) AS ganados, CAST(sum(partidos_empatados) AS BIGINT) AS empatados, CAST(sum(partidos_perdidos) AS BIGINT) AS perdidos,
    CAST(sum(partidos_jugados) AS BIGINT) AS jugados, CAST(sum(puntos) AS BIGINT) AS puntos FROM posiciones WHERE {ACC} AND lower(nombre_equipo) LIKE '%00004%' GROUP BY 1""")(
    lambda L: Q.wins_draws_losses(L.tables, "00004"))
PE = "(SELECT a.*, e.nombre_equipo AS rival FROM partidos_equipo a JOIN dim e ON e.id_equipo = a.id_rival WHERE estado_partido = 'Disputado')"
league_query("Q07_partidos_equipo", f"""SELECT nombre_equipo, temporada, CAST(fecha_partido AS VARCHAR) AS fecha_partido, rol_equipo, rival, goles_favor, goles_contra, resultado, posesion_pct, tiros_totales, disparos_puerta,
    tarjetas_amarillas, 0 AS tarjetas_rojas FROM {PE} WHERE nombre_equipo LIKE '%00002%' AND temporada = 1998 ORDER BY fecha_partido DESC, id_partido, rol_equipo LIMIT 10""")(
    lambda L: Q.recent_matches(L.team_matches, L.tb_dim, "00002", 1998))
league_query("Q08_mayor_goleada", f"""SELECT nombre_equipo AS equipo_ganador, rival AS equipo_perdedor, temporada, CAST(fecha_partido AS VARCHAR) AS fecha_partido, resultado, goles_favor, goles_contra, diferencia_goles FROM {PE}
    WHERE temporada = (SELECT max(temporada) FROM {PE}) AND goles_favor > goles_contra ORDER BY diferencia_goles DESC, goles_favor DESC, id_partido, rol_equipo LIMIT 10""")(
    lambda L: Q.biggest_wins(L.team_matches, L.tb_dim))
league_query("Q09_vs_equipos", """SELECT nombre_equipo, count(*) AS partidos, CAST(sum(goles_favor) AS BIGINT) AS goles_marcados, CAST(sum(goles_contra) AS BIGINT) AS goles_recibidos, round(avg(posesion_pct), 1) AS posesion_media_pct,
    round(avg(tiros_totales), 1) AS tiros_promedio, round(avg(disparos_puerta), 1) AS disparos_puerta_promedio, count(*) FILTER (goles_favor > goles_contra) AS victorias, count(*) FILTER (goles_favor = goles_contra) AS empates,
    count(*) FILTER (goles_favor < goles_contra) AS derrotas, round(avg(tarjetas_amarillas), 2) AS amarillas_promedio FROM partidos_equipo WHERE estado_partido = 'Disputado' AND (nombre_equipo LIKE '%00001%' OR nombre_equipo LIKE '%00006%') GROUP BY 1""")(
    lambda L: Q.compare_teams(L.team_matches, "00001", "00006"))
league_query("Q10_partido_rival", f"""SELECT nombre_equipo AS equipo, rival, temporada, CAST(fecha_partido AS VARCHAR) AS fecha_partido, resultado, rol_equipo, goles_favor, goles_contra,
    CASE WHEN goles_favor > goles_contra THEN 'Victoria' WHEN goles_favor = goles_contra THEN 'Empate' ELSE 'Derrota' END AS resultado_final FROM {PE}
    WHERE nombre_equipo LIKE '%00001%' AND rival LIKE '%00009%' ORDER BY fecha_partido DESC, id_partido, rol_equipo LIMIT 10""")(
    lambda L: Q.head_to_head(L.team_matches, L.tb_dim, "00001", "00009"))
league_query("Q11_goles_por_equipo", """SELECT nombre_equipo, temporada, CAST(sum(goles_favor) AS BIGINT) AS goles_marcados, CAST(sum(goles_contra) AS BIGINT) AS goles_recibidos, count(*) AS partidos_jugados FROM partidos_equipo
    WHERE estado_partido = 'Disputado' AND temporada = (SELECT max(temporada) FROM partidos_equipo WHERE estado_partido = 'Disputado') GROUP BY 1, 2 ORDER BY goles_marcados DESC, nombre_equipo LIMIT 15""")(
    lambda L: Q.goals_by_team(L.team_matches))
league_query("Q12_precision_tiro", """SELECT nombre_equipo, temporada, CAST(sum(tiros_totales) AS BIGINT) AS tiros_totales, CAST(sum(disparos_puerta) AS BIGINT) AS disparos_puerta, CAST(sum(goles_favor) AS BIGINT) AS goles,
    round(sum(disparos_puerta) * 100.0::DOUBLE / nullif(sum(tiros_totales), 0), 1) AS precision_tiro_pct, round(sum(goles_favor) * 100.0::DOUBLE / nullif(sum(disparos_puerta), 0), 1) AS conversion_pct FROM partidos_equipo
    WHERE estado_partido = 'Disputado' AND tiros_totales > 0 GROUP BY 1, 2 ORDER BY precision_tiro_pct DESC, nombre_equipo, temporada LIMIT 20""")(
    lambda L: Q.shot_precision(L.team_matches))
league_query("Q13_estadisticas_jugador", """SELECT jugador, nombre_equipo, temporada, posicion, partidos_jugados, titularidades, goles, asistencias, tarjetas_amarillas, tarjetas_rojas, minutos_jugados, round(ppp, 6) AS ppp FROM stats_vw
    WHERE jugador LIKE '%red%' AND jugador LIKE '%bolt%' ORDER BY temporada DESC, id_estadistica_jugador LIMIT 10""")(
    lambda L: Q.player_statistics(L.stats_view, "bolt RED").withColumn("ppp", F.round("ppp", 6)))
league_query("Q14_top_goleadores", """SELECT jugador, nombre_equipo, temporada, posicion, goles, asistencias, partidos_jugados, minutos_jugados FROM stats_vw WHERE goles > 0 AND temporada = (SELECT max(temporada) FROM stats_vw WHERE goles > 0)
    ORDER BY goles DESC, id_estadistica_jugador LIMIT 10""")(lambda L: Q.top_scorers(L.stats_view))
league_query("Q15_vs_jugadores", """SELECT jugador, nombre_equipo, temporada, posicion, partidos_jugados, titularidades, goles, asistencias, minutos_jugados, tarjetas_amarillas, round(ppp, 6) AS ppp FROM stats_vw
    WHERE temporada = 1997 AND (jugador LIKE '%red bolt%' OR (jugador LIKE '%small%' AND jugador LIKE '%anvil%'))""")(
    lambda L: Q.compare_players(L.stats_view, "red bolt", "anvil small", 1997).withColumn("ppp", F.round("ppp", 6)))
_P10 = "(SELECT * FROM stats_vw WHERE {c} ORDER BY temporada DESC, id_estadistica_jugador)"
_ONE, _TWO = _P10.format(c="jugador LIKE '%red%' AND jugador LIKE '%bolt%'"), _P10.format(c="jugador LIKE '%small%' AND jugador LIKE '%ring%'")
league_query("Q15_temporadas_comunes", f"""SELECT jugador, nombre_equipo, temporada, posicion, partidos_jugados, titularidades, goles, asistencias, tarjetas_amarillas, tarjetas_rojas, minutos_jugados, round(ppp, 6) AS ppp
    FROM (SELECT * FROM {_ONE} UNION ALL SELECT * FROM {_TWO}) WHERE temporada IN (SELECT temporada FROM {_ONE} INTERSECT SELECT temporada FROM {_TWO})
    OR NOT EXISTS (SELECT temporada FROM {_ONE} INTERSECT SELECT temporada FROM {_TWO})""")(
    lambda L: Q.compare_common_seasons(L.stats_view, "red bolt", "small ring").withColumn("ppp", F.round("ppp", 6)))
PP = """(SELECT jugador, nombre_equipo, temporada, max(posicion) AS posicion, max(nivel) AS nivel, max(score_100) AS score_100, max(partidos_jugados) AS partidos_jugados, max(minutos_jugados) AS minutos_jugados,
    max(goles) AS goles, max(asistencias) AS asistencias FROM score_vw WHERE {w} GROUP BY 1, 2, 3)"""
LAST = "temporada = (SELECT max(temporada) FROM score_vw)"
league_query("Q16_score_ml", f"SELECT jugador, nombre_equipo, posicion, nivel, score_100, temporada FROM {PP.format(w=LAST)} ORDER BY score_100 DESC, jugador, nombre_equipo LIMIT 15")(
    lambda L: Q.best_scores(L.score_view, seasons=L.score_seasons))
_DEF = LAST + " AND posicion_xi IN ('DFC', 'LD', 'LI')"
league_query("Q16_score_ml_posicion", f"SELECT jugador, nombre_equipo, posicion, nivel, score_100, temporada FROM {PP.format(w=_DEF)} ORDER BY score_100 DESC, jugador, nombre_equipo LIMIT 15")(
    lambda L: Q.best_scores(L.score_view, position="defensor", seasons=L.score_seasons))
_BOLT = "jugador LIKE '%bolt%'"
league_query("Q17_score_ml_evolucion", f"SELECT jugador, nombre_equipo, temporada, score_100, nivel, goles, asistencias, partidos_jugados FROM {PP.format(w=_BOLT)}")(
    lambda L: Q.score_history(L.score_view, "bolt"))
S = "jugador, nombre_equipo, posicion, nivel, score_100, partidos_jugados, minutos_jugados, goles, asistencias, temporada"
league_query("Q18_gemas_ocultas", f"SELECT {S} FROM {PP.format(w=LAST)} WHERE score_100 >= 10 AND partidos_jugados <= 40 ORDER BY score_100 DESC, jugador, nombre_equipo LIMIT 15")(
    lambda L: Q.hidden_gems(L.score_view, None, 10, 40, seasons=L.score_seasons))
league_query("Q19_bajo_rendimiento", f"SELECT {S} FROM {PP.format(w=LAST)} WHERE partidos_jugados >= 15 AND score_100 < 50 ORDER BY score_100, jugador, nombre_equipo LIMIT 15")(
    lambda L: Q.under_performers(L.score_view, seasons=L.score_seasons))
league_query("Q20_perfil_jugador", """SELECT e.jugador, e.nombre_equipo, e.temporada, e.posicion, e.goles, e.asistencias, e.partidos_jugados, e.minutos_jugados, p.altura, p.pie, p.valor_mercado, p.edad_historica, p.nacionalidad_principal
    FROM stats_vw e LEFT JOIN plantillas_vw p USING (id_jugador, temporada, id_equipo) WHERE e.jugador LIKE '%hot gear%' ORDER BY e.temporada DESC, e.id_estadistica_jugador LIMIT 10""")(
    lambda L: Q.player_profile(L.stats_view, L.squad_view, "Hot Gear"))


@query("Q21_resolver_formacion", """SELECT o_orderkey, f, e, CASE WHEN f = '4-3-3' AND e = 'equilibrado' THEN 5 WHEN f = '4-3-3' THEN 1 WHEN f = '4-2-3' THEN 3 WHEN f = '541' THEN 7 WHEN f = '' AND e = 'equilibrado' THEN 3
    WHEN f = '' AND e = 'defensivo' THEN 6 ELSE 1 END AS id_formacion FROM (SELECT o_orderkey, ['4-3-3', '4-2-3', '541', '', '9-9-9'][CAST(o_orderkey % 5 AS INT) + 1] AS f, CASE o_orderstatus WHEN 'F' THEN 'equilibrado' WHEN 'O' THEN 'defensivo' ELSE '' END AS e FROM orders)
    WHERE f <> '9-9-9' OR e = '' UNION ALL SELECT o_orderkey, '9-9-9', e, CASE e WHEN 'equilibrado' THEN 3 ELSE 6 END FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'equilibrado' WHEN 'O' THEN 'defensivo' ELSE '' END AS e FROM orders WHERE o_orderkey % 5 = 4) WHERE e <> ''""")
def _(s, sf):
    shapes = F.array(*[F.lit(x) for x in ("4-3-3", "4-2-3", "541", "", "9-9-9")])
    rows = table(s, sf, "orders").select("o_orderkey", F.get(shapes, F.col("o_orderkey") % 5).alias("f"),
                                         F.when(F.col("o_orderstatus") == "F", "equilibrado").when(F.col("o_orderstatus") == "O", "defensivo").otherwise("").alias("e"))
    return Q.formation_for(rows, "f", "e")


league_query("Q21_formaciones_usadas", """SELECT id_formacion, formacion, estilo, formacion || ' - ' || estilo AS formacion_display, n FROM (SELECT id_formacion, count(*) AS n FROM score_vw GROUP BY 1)
    JOIN (VALUES (1, '4-3-3', 'Ofensivo'), (2, '3-4-3', 'Ofensivo'), (3, '4-2-3-1', 'Equilibrado'), (4, '4-4-2', 'Equilibrado'), (5, '4-3-3', 'Equilibrado'), (6, '5-3-2', 'Defensivo'), (7, '5-4-1', 'Defensivo'), (8, '4-1-4-1', 'Defensivo')) t(id_formacion, formacion, estilo) USING (id_formacion)""")(
    lambda L: Q.available_formations(views.formations(L.spark)).join(L.score_view.groupBy("id_formacion").agg(F.count(F.lit(1)).alias("n")), "id_formacion"))
_XI = f"(SELECT * FROM score_vw WHERE {LAST} AND id_formacion = 4 QUALIFY row_number() OVER (PARTITION BY slot ORDER BY score_100 DESC, id_jugador, id_equipo) = 1)"
league_query("Q22_mejor_xi", f"""SELECT jugador, nombre_equipo, alias_equipo, posicion_xi, posicion_xi_nombre, score_100, nivel, foto_url, goles, asistencias, participaciones_gol, partidos_jugados, minutos_jugados, x_coord, y_coord, slot, orden,
    (SELECT round(avg(score_100), 2) FROM {_XI}) AS score_medio_xi FROM {_XI}""")(lambda L: Q.best_eleven(L.score_view, formation=4, seasons=L.score_seasons))
league_query("Q23_plantilla_equipo", """SELECT jugador, posicion, edad_historica, nacionalidad_principal, pie, numero_camiseta, valor_mercado, nombre_equipo, temporada FROM plantillas_vw WHERE nombre_equipo LIKE '%00007%' AND temporada = (SELECT max(temporada) FROM plantillas_vw)
    ORDER BY valor_mercado DESC, id_plantilla_equipo""")(lambda L: Q.team_squad(L.squad_view, "00007"))
V = "nombre_equipo, temporada, jugadores_en_plantilla, edad_promedio, extranjeros, valor_medio, valor_total"
league_query("Q24_valoracion_equipos", f"SELECT {V} FROM ft_valor WHERE temporada BETWEEN 1996 AND 1998 ORDER BY temporada, valor_total DESC, nombre_equipo")(
    lambda L: Q.team_values(L.tb_value_history, start=1996, end=1998))
league_query("Q24_valoracion_ultima", f"SELECT {V} FROM ft_valor WHERE temporada = (SELECT max(temporada) FROM ft_valor) ORDER BY valor_total DESC, nombre_equipo")(
    lambda L: Q.team_values(L.tb_value_history))
league_query("Q25_evolucion_valor_liga", """SELECT temporada, round(sum(valor_total) / 1000000, 2) AS valor_total_mm_eur, round(avg(edad_promedio), 1) AS edad_promedio_liga, round(avg(extranjeros), 1) AS extranjeros_promedio,
    count(DISTINCT nombre_equipo) AS equipos FROM ft_valor WHERE temporada >= 1996 GROUP BY 1""")(lambda L: Q.league_value_history(L.tb_value_history, 1996))
league_query("Q26_entrenadores", """SELECT nombre_equipo, entrenador, nacionalidad_principal, temporada, partidos, ppp, tiempo_en_cargo, entrenador_activo, CAST(fecha_inicio AS VARCHAR) AS fecha_inicio, CAST(fecha_termino AS VARCHAR) AS fecha_termino
    FROM ft_entrenadores WHERE partidos >= 5 ORDER BY ppp DESC, partidos DESC, id_entrenador_equipo LIMIT 15""")(lambda L: Q.best_coaches(L.tb_coach_history))
league_query("Q27_vs_detalle", """SELECT equipo, count(*) AS partidos_con_datos, round(avg(pases), 0) AS pases_promedio, round(avg(pp), 0) AS pases_precisos_promedio, round(avg(pct) * 100, 1) AS precision_pases_pct, round(avg(dg), 0) AS duelos_ganados_promedio,
    round(avg(ag), 0) AS aereos_ganados_promedio, round(avg(en), 0) AS entradas_promedio, round(avg(rr), 0) AS regates_realizados_promedio FROM (
    SELECT nombre_equipo_local AS equipo, pases_local AS pases, pases_precisos_local AS pp, pases_precisos_local_pct AS pct, duelos_ganados_local AS dg, aereo_ganado_local AS ag, entradas_local AS en, regates_realizados_local AS rr FROM ft_detalle
    UNION ALL SELECT nombre_equipo_visitante, pases_visitante, pases_precisos_visitante, pases_precisos_visitante_pct, duelos_ganados_visitante, aereo_ganado_visitante, entradas_visitante, regates_realizados_visitante FROM ft_detalle)
    WHERE pases > 0 AND (equipo LIKE '%00001%' OR equipo LIKE '%00008%') GROUP BY 1""")(lambda L: Q.compare_match_details(L.tb_match_detail, "00001", "00008"))
league_query("Q28_vs_entrenadores", """SELECT entrenador, count(DISTINCT nombre_equipo) AS equipos_dirigidos, count(DISTINCT temporada) AS temporadas, CAST(sum(partidos) AS BIGINT) AS partidos_totales, round(CAST(sum(CAST(round(ppp * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*), 2) AS ppp_promedio,
    round(max(ppp), 2) AS mejor_ppp_temporada, round(min(ppp), 2) AS peor_ppp_temporada, max(CAST(tiempo_en_cargo AS INT)) AS max_dias_en_cargo FROM ft_entrenadores WHERE partidos >= 3 AND (entrenador LIKE '%000012%' OR entrenador LIKE '%000077%') GROUP BY 1""")(
    lambda L: Q.compare_coaches(L.tb_coach_history, "000012", "000077"))
league_query("Q29_rendimiento_equipo", f"SELECT {T} FROM posiciones WHERE nombre_equipo LIKE '%00003%' AND partidos_jugados > 0 ORDER BY temporada DESC, tipo_tabla, posicion, nombre_equipo")(
    lambda L: Q.team_performance(L.tables, "00003"))
league_query("Q30_campeones", "SELECT temporada, a.nombre_equipo AS campeon, b.nombre_equipo AS subcampeon FROM hm_campeones LEFT JOIN dim a ON a.id_equipo = id_equipo_campeon LEFT JOIN dim b ON b.id_equipo = id_equipo_subcampeon ORDER BY temporada DESC")(
    lambda L: Q.champions(L.tb_champions, L.tb_dim))
_MET = ["puntos", "goles_favor", "goles_contra"]
league_query("Q31_perfil_comparado", """WITH l AS (SELECT * FROM posiciones WHERE tipo_tabla = 'Acumulado' AND nombre_equipo IN ('Supplier#000000001', 'Supplier#000000004') QUALIFY row_number() OVER (PARTITION BY nombre_equipo ORDER BY temporada DESC) = 1),
    u AS (SELECT nombre_equipo, 'puntos' AS metrica, CAST(puntos AS DOUBLE) AS valor FROM l UNION ALL SELECT nombre_equipo, 'goles_favor', CAST(goles_favor AS DOUBLE) FROM l UNION ALL SELECT nombre_equipo, 'goles_contra', CAST(goles_contra AS DOUBLE) FROM l)
    SELECT nombre_equipo, metrica, valor, round(valor / greatest(max(abs(valor)) OVER (PARTITION BY metrica), 0.01) * 100, 4)::DOUBLE AS escala FROM u""".replace("WITH l AS", "SELECT * FROM (WITH l AS") + ")")(
    lambda L: Q.comparison_profile(L.tables.filter("tipo_tabla = 'Acumulado'"), "nombre_equipo", "Supplier#000000001", "Supplier#000000004", _MET))
league_query("Q31_radar", """SELECT id_jugador, id_equipo, temporada, posicion_xi, round(score_100 / 100.0, 4)::DOUBLE AS radar_score, round(CASE WHEN posicion_xi = 'POR' THEN partidos_imbatido / 10.0 ELSE goles_p90 / 1.65 END, 4)::DOUBLE AS radar_goles,
    round(CASE WHEN posicion_xi = 'POR' THEN -gc_p90 / 3.0 ELSE asistencias_p90 / 0.92 END, 4)::DOUBLE AS radar_asistencias, round(ppp / 3.0, 4)::DOUBLE AS radar_ppp, round(minutos_jugados / 3240.0, 4)::DOUBLE AS radar_minutos FROM score""")(
    lambda L: Q.player_radar(L.tb_simple_score))
KPI = """SELECT count(DISTINCT temporada) AS total_temporadas, count(*) AS total_partidos, (SELECT count(*) FROM dim) AS total_equipos, (SELECT arg_max(nombre_equipo, temporada) FROM hm_campeones JOIN dim ON id_equipo = id_equipo_campeon) AS campeon_ultimo,
    (SELECT round(sum(valor_total) * 4.0, 2) FROM ft_valor WHERE temporada = (SELECT max(temporada) FROM ft_valor)) AS valor_total_plantel, (SELECT round(sum(valor_total) * 4.0 / 1000000, 2) FROM ft_valor WHERE temporada = (SELECT max(temporada) FROM ft_valor)) AS valor_total_plantel_mm,
    (SELECT round(sum(valor_total) * 4.0 / sum(jugadores_en_plantilla), 2) FROM ft_valor WHERE temporada = (SELECT max(temporada) FROM ft_valor)) AS valor_promedio_jugador FROM hm_partidos"""
league_query("Q32_kpi", KPI)(lambda L: Q.kpi_snapshot(L.tb_matches, L.tb_dim, L.tb_value_history, L.tb_champions, 4.0))
league_query("A18_kpi_tipo_cambio", KPI.replace("4.0", "3.75"))(lambda L: Q.kpi_snapshot(L.tb_matches, L.tb_dim, L.tb_value_history, L.tb_champions, 3.75))
league_query("Q33_nombres_conocidos", "SELECT lower(nombre_equipo) AS nombre FROM dim UNION SELECT lower(alias_equipo) FROM dim WHERE length(alias_equipo) >= 4")(
    lambda L: Q.known_team_names(L.tb_dim))
_ONE = "concat_ws('|', jugador, nombre_equipo, CAST(temporada AS VARCHAR), posicion_xi)"
league_query("A20_resumen_score", f"""SELECT nivel AS grupo, count(*) AS jugadores, round(avg(score_100), 2) AS score_medio, 'nivel' AS tipo FROM score GROUP BY 1
    UNION ALL SELECT CAST(temporada AS VARCHAR), count(*), round(avg(score_100), 2), 'temporada' FROM score GROUP BY 1
    UNION ALL SELECT {_ONE}, count(*), round(avg(score_100), 2), 'gema' FROM score WHERE nivel IN ('Bueno', 'Elite') AND minutos_jugados <= 2600 GROUP BY 1
    UNION ALL SELECT {_ONE}, count(*), round(avg(score_100), 2), 'titular_bajo' FROM score WHERE minutos_jugados >= 1000 AND score_100 <= 40 GROUP BY 1""")(
    lambda L: scoring.score_summary(L.tb_simple_score, few_minutes=2600, many_minutes=1000, low_score=40.0))
league_query("L1_rasgos_de_jugador", "SELECT id_jugador, id_equipo, temporada, posicion_xi, " + ", ".join(f"round({c}, 9) AS {c}" for c in scoring.RATES) + " FROM feats")(
    lambda L: scoring.player_features(L.tb_player_season_stats, L.squad_history).select("id_jugador", "id_equipo", "temporada", "posicion_xi", *[F.round(c, 9).alias(c) for c in scoring.RATES]))
league_query("L5_claves_de_score", "SELECT id_score_ml, round(score_100, 6) AS score_100, nivel_num, nivel FROM score")(
    lambda L: L.tb_simple_score.select("id_score_ml", F.round("score_100", 6).alias("score_100"), "nivel_num", "nivel"))
