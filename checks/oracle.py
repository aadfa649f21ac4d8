"""SQL forms of the league entities, straight from the supplied tables.

The statements work on the numbers behind the raw texts, so they check parsing as well as joining.
"""

from __future__ import annotations

import re

PLACES = ["Portero", "Defensa Central", "Lateral Izquierdo", "Lateral Derecho", "Mediocampista Defensivo",
          "Mediocampista Central", "Mediocampista Ofensivo", "Mediocampista Izquierdo", "Mediocampista Derecho",
          "Extremo Izquierdo", "Extremo Derecho", "Segundo Delantero", "Delantero Centro"]
_PLACE = "[" + ", ".join(f"'{p}'" for p in PLACES) + "][CAST(p_size % 13 AS INT) + 1]"
_XI = ("CASE posicion WHEN 'Portero' THEN 'POR' WHEN 'Defensa Central' THEN 'DFC' WHEN 'Lateral Derecho' THEN 'LD' "
       "WHEN 'Lateral Izquierdo' THEN 'LI' WHEN 'Mediocampista Defensivo' THEN 'MCD' WHEN 'Mediocampista Central' THEN 'MC' "
       "WHEN 'Mediocampista Izquierdo' THEN 'MC' WHEN 'Mediocampista Derecho' THEN 'MC' WHEN 'Mediocampista Ofensivo' THEN 'MCO' "
       "WHEN 'Extremo Izquierdo' THEN 'EI' WHEN 'Extremo Derecho' THEN 'ED' WHEN 'Delantero Centro' THEN 'DC' ELSE 'OTRO' END")


def _i(expr: str, name: str) -> str:
    return f"CAST({expr} AS INT) AS {name}"


def _sum(expr: str, name: str) -> str:
    return _i(f"sum({expr})", name)


def _if(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


_Q = "CAST(l_quantity AS INT)"
# (column, raw expression) of the statistics the raw frame carries; the rest of the columns are zero.
STAT_VALUES = {
    "tiros_totales_local": "gl + q % 7", "tiros_totales_visitante": "gv + q % 5", "disparos_puerta_local": "gl",
    "disparos_puerta_visitante": "gv", "pases_local": "q", "pases_visitante": "q % 97", "pases_precisos_local": "q % 50",
    "pases_precisos_visitante": "q % 40", "tarjetas_amarillas_local": "q % 4", "tarjetas_amarillas_visitante": "q % 3",
    "duelos_ganados_local": "q % 31", "duelos_ganados_visitante": "q % 29", "entradas_local": "q % 17",
    "entradas_visitante": "q % 13", "aereo_ganado_local": "q % 9", "aereo_ganado_visitante": "q % 8",
    "regates_realizados_local": "q % 6", "regates_realizados_visitante": "q % 7", "posesion_local": "30 + q % 40",
    "posesion_visitante": "70 - q % 40",
}
SHARE_VALUES = {
    "pases_precisos_local_pct": "(q % 101) / 100.0", "pases_precisos_visitante_pct": "(q % 51) / 100.0",
    "aereo_ganado_local_pct": "(q % 71) / 100.0", "posesion_local_pct": "(30 + q % 40) / 100.0",
    "posesion_visitante_pct": "(70 - q % 40) / 100.0",
}

_PLAYER_SUMS = ["partidos_jugados", "titularidades", "asistencias", "tarjetas_amarillas", "tarjeta_amarilla_roja",
                "tarjetas_rojas", "entrada_suplente", "salida_suplente", "goles_en_contra", "partidos_imbatido", "minutos_jugados"]

CTES: dict[str, str] = {
    "cat": """SELECT CAST(s_suppkey AS INT) AS id_equipo, s_name AS nombre_equipo, 'FC ' || s_name AS nombre_fotmob,
        CASE WHEN s_acctbal >= 1000 THEN 'Club ' || replace(s_name, '#', ' ') ELSE 'Otro ' || s_suppkey END AS nombre_transfermarkt,
        'S' || s_suppkey AS alias, replace(s_name, 'Supplier', 'Súpplier') AS nombre_fotmob_clasificacion,
        CASE WHEN s_suppkey % 2 = 0 THEN 'Sup ' || s_suppkey ELSE '' END AS nombre_fotmob_clas_alt FROM supplier""",
    "known": "SELECT s_suppkey FROM supplier WHERE s_acctbal >= 1000",
    "mb": f"""SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, CAST(year(o_orderdate) AS INT) AS season, m.* FROM orders
        JOIN (SELECT l_orderkey, min(l_suppkey) AS lo, max(l_suppkey) AS hi, {_sum(_if(_Q + ' > 25'), 'gl')},
              {_sum(_if(_Q + ' <= 25'), 'gv')}, {_sum(_Q, 'q')} FROM lineitem GROUP BY l_orderkey) m ON o_orderkey = l_orderkey""",
    "hm_partidos": """SELECT sha256(season || '-https://m/' || o_orderkey) AS id_partido, CAST(lo AS INT) AS id_equipo_local,
        CAST(hi AS INT) AS id_equipo_visitante, season AS temporada, CAST(o_orderdate AS DATE) AS fecha_partido,
        CASE WHEN o_orderstatus = 'P' THEN 'sin informacion' ELSE gl || ' - ' || gv END AS marcador,
        CASE WHEN o_orderstatus <> 'P' THEN gl END AS goles_local, CASE WHEN o_orderstatus <> 'P' THEN gv END AS goles_visitante,
        'https://m/' || o_orderkey AS url, 'sitio' AS fuente_partido, season AS periodo, q, gl, gv, o_orderstatus FROM mb""",
    "hm_stats": "SELECT id_partido, id_equipo_local, id_equipo_visitante, temporada, CASE WHEN o_orderstatus = 'P' THEN 'Sin jugar' ELSE marcador END AS marcador, "
                "coalesce(goles_local, 0) AS goles_local, coalesce(goles_visitante, 0) AS goles_visitante, url, fecha_partido AS fecha_stats, "
                + ", ".join(_i(e, c) for c, e in STAT_VALUES.items()) + ", "
                + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in SHARE_VALUES.items()) + ", 'sitio' AS fuente, periodo FROM hm_partidos",
    "tb": f"""SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS season, CASE WHEN month(l_shipdate) <= 6 THEN 'Apertura' ELSE 'Clausura' END AS tipo,
        {_sum('1', 'pj')}, {_sum(_if(_Q + ' > 34'), 'pg')}, {_sum(_if(_Q + ' > 17 AND ' + _Q + ' <= 34'), 'pe')},
        {_sum(_if(_Q + ' <= 17'), 'pp')}, {_sum(_Q + ' % 5', 'gf')}, {_sum(_Q + ' % 4', 'gc')} FROM lineitem GROUP BY 1, 2, 3""",
    "hm_tablas": """SELECT sha256(season || '-' || tipo || '-' || l_suppkey) AS id_clasificacion, CAST(l_suppkey AS INT) AS id_equipo, season AS temporada,
        tipo AS tipo_tabla, CAST(pj % 20 + 1 AS INT) AS posicion, pj AS partidos_jugados, pg AS partidos_ganados, pe AS partidos_empatados,
        pp AS partidos_perdidos, gf AS goles_favor, gc AS goles_contra, gf - gc AS diferencia_goles, 3 * pg + pe AS puntos, season AS periodo FROM tb""",
    "vb": """SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS season, CAST(count(DISTINCT l_partkey) AS INT) AS n,
        CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS t FROM lineitem GROUP BY 1, 2""",
    "hm_valor": """SELECT sha256(l_suppkey || '-' || season) AS id_valoracion_equipo, CAST(l_suppkey AS INT) AS id_equipo, season AS temporada,
        n AS jugadores_en_plantilla, CAST((20 + n % 10) || '.' || (n % 7) AS DOUBLE) AS edad_promedio, CAST(n % 12 AS INT) AS extranjeros,
        CAST((100 + n % 800) * 1000 AS DOUBLE) AS valor_medio, CAST((t // 10000) * 10000 AS DOUBLE) AS valor_total,
        'mercado' AS fuente_valoracion, season AS periodo FROM vb WHERE l_suppkey IN (SELECT s_suppkey FROM known)""",
    "md_equipos": """SELECT id_equipo, nombre_equipo, alias AS alias_equipo, lower(nombre_fotmob) AS equipo_raw, 'https://t/' || lower(nombre_fotmob) AS url_equipo,
        'sitio' AS fuente_equipo FROM cat WHERE id_equipo IN (SELECT lo FROM mb UNION SELECT hi FROM mb)""",
    "md_estadios": """SELECT sha256(s_suppkey || '-estadio ' || s_suppkey) AS id_estadio, CAST(s_suppkey AS INT) AS id_equipo, 'Estadio ' || s_suppkey AS estadio,
        CASE WHEN s_nationkey = 0 THEN 'sin informacion' ELSE CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) END AS capacidad,
        CASE WHEN s_nationkey > 3 THEN CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) ELSE 'sin informacion' END AS aforo, 'mercado' AS fuente_estadio
        FROM supplier WHERE s_acctbal >= 1000 AND s_acctbal <= 9000""",
    "sb": f"""SELECT l_partkey, l_suppkey, CAST(year(l_shipdate) AS INT) AS season, min(l_shipdate) AS signed, max({_Q}) AS number,
        any_value(p_name) AS p_name, any_value(p_size) AS p_size, any_value(p_brand) AS p_brand, any_value(p_type) AS p_type,
        any_value(p_retailprice) AS p_retailprice FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
    "md_plantillas": """SELECT sha256(CASE WHEN p_size <> 50 THEN CAST(l_partkey + 1 AS VARCHAR) ELSE p_name || ' ' || l_partkey END) AS id_jugador,
        CASE WHEN p_size <> 50 THEN CAST(l_partkey + 1 AS VARCHAR) END AS id_tm, p_name || ' ' || l_partkey AS jugador,
        CAST(date_sub('year', make_date(CAST(1970 + p_size % 30 AS INT), CAST(p_size % 12 + 1 AS INT), CAST(p_size % 28 + 1 AS INT)), DATE '2024-06-30') AS INT) AS edad,
        p_brand AS nacionalidad_principal, p_type AS segunda_nacionalidad, CASE WHEN tall THEN CAST('1.' || (p_size % 40 + 60) AS DOUBLE) ELSE 0.0 END AS altura,
        CASE WHEN NOT odd THEN 'sin informacion' WHEN p_size % 4 = 0 THEN 'left' ELSE 'right' END AS pie,
        CAST(CAST(floor(p_retailprice) AS BIGINT) * 1000 AS DOUBLE) AS valor_mercado, 'https://img/' || l_partkey || '.jpg?lm=1' AS foto_url,
        'mercado' AS fuente_plantilla, l_partkey, p_size
        FROM (SELECT l_partkey, any_value(p_name) AS p_name, any_value(p_size) AS p_size, any_value(p_brand) AS p_brand, any_value(p_type) AS p_type,
              any_value(p_retailprice) AS p_retailprice, bool_or(season % 2 = 1) AS odd, bool_or(NOT (season % 2 = 1 AND p_size % 7 = 0)) AS tall FROM sb GROUP BY l_partkey)""",
    "hm_plantillas": f"""SELECT sha256(l_suppkey || '-' || m.id_jugador || '-' || season || '-' || lower({_PLACE.replace('p_size', 's.p_size')})) AS id_plantilla_equipo,
        CAST(l_suppkey AS INT) AS id_equipo, m.id_jugador, m.id_tm, season AS temporada, CAST(number AS VARCHAR) AS numero_camiseta,
        {_PLACE.replace('p_size', 's.p_size')} AS posicion, CAST(signed AS DATE) AS fecha_fichaje, 'mercado' AS fuente_plantilla, season AS periodo
        FROM sb s JOIN md_plantillas m USING (l_partkey) WHERE l_suppkey IN (SELECT s_suppkey FROM known)""",
    "psb": f"""SELECT l_partkey, l_suppkey, CAST(year(l_shipdate) AS INT) AS season, l_returnflag, {_sum(_Q, 'q')} FROM lineitem GROUP BY 1, 2, 3, 4""",
    "hm_jugadores": """SELECT sha256(m.id_tm || '-' || l_suppkey || '-' || season || '-liga ' || lower(l_returnflag)) AS id_estadistica_jugador, m.id_jugador, m.id_tm,
        m.jugador, CAST(l_suppkey AS INT) AS id_equipo, season AS temporada, 'Liga ' || l_returnflag AS competencia, q AS partidos_jugados,
        CAST(q % 23 AS INT) AS titularidades, CAST(q % 4 + 0.25 AS DOUBLE) AS ppp, CAST(q % 13 AS INT) AS goles, CAST(q % 7 AS INT) AS asistencias,
        CAST(q % 5 AS INT) AS tarjetas_amarillas, CAST(q % 2 AS INT) AS tarjeta_amarilla_roja, CAST(q % 3 AS INT) AS tarjetas_rojas,
        CAST(q % 6 AS INT) AS entrada_suplente, CAST(q % 4 AS INT) AS salida_suplente, CAST(q % 2 AS INT) AS penaltis_anotados,
        CAST(q % 9 AS INT) AS goles_en_contra, CAST(q % 5 AS INT) AS partidos_imbatido, q AS min_por_gol, CAST(q * 40 AS INT) AS minutos_jugados,
        q % 11 <> 0 AS datos_disponibles, 'Transfermarkt' AS fuente, season AS periodo
        FROM psb JOIN md_plantillas m USING (l_partkey) WHERE m.p_size <> 50 AND l_suppkey IN (SELECT s_suppkey FROM known)""",
    "cb": """SELECT o_custkey, lo, o_orderdate, max(q) AS q, max(gl) AS gl, max(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS open FROM mb GROUP BY 1, 2, 3""",
    "md_entrenadores": """SELECT sha256('customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '-' || CAST(born AS VARCHAR)) AS id_entrenador,
        'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS entrenador, CAST(date_sub('year', born, DATE '2024-06-30') AS INT) AS edad,
        'País ' || (o_custkey % 25) AS nacionalidad_principal, 'País ' || (o_custkey % 7) AS segunda_nacionalidad, 'mercado' AS fuente_entrenador, o_custkey
        FROM (SELECT DISTINCT o_custkey, make_date(CAST(1950 + o_custkey % 30 AS INT), CAST(o_custkey % 12 + 1 AS INT), CAST(o_custkey % 28 + 1 AS INT)) AS born FROM cb)""",
    "hm_entrenadores": """SELECT sha256(lo || '-' || id_entrenador || '-' || strftime(o_orderdate, '%d/%m/%Y')) AS id_entrenador_equipo, CAST(lo AS INT) AS id_equipo,
        id_entrenador, CAST(year(o_orderdate) AS INT) AS temporada, CAST(o_orderdate AS DATE) AS fecha_inicio,
        CASE WHEN open = 0 THEN CAST(o_orderdate AS DATE) + CAST(q % 300 AS INT) END AS fecha_termino, CAST(q AS VARCHAR) AS tiempo_en_cargo,
        CAST(q % 30 AS INT) AS partidos, CAST((q % 3) || '.' || lpad(CAST(q % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS ppp, open AS entrenador_activo,
        'mercado' AS fuente_entrenador, CAST(year(o_orderdate) AS INT) AS periodo
        FROM cb JOIN md_entrenadores USING (o_custkey) WHERE lo IN (SELECT s_suppkey FROM known)""",
    "champ": """SELECT season, arg_min(l_suppkey, (-pts, l_suppkey)) AS a, arg_min(l_suppkey, (pts, l_suppkey)) AS b
        FROM (SELECT season, l_suppkey, sum(3 * pg + pe) AS pts FROM tb GROUP BY 1, 2) GROUP BY season""",
    "hm_campeones": """SELECT sha256(season || '|' || ca || '|' || cb) AS id_campeonato, CAST(a AS INT) AS id_equipo_campeon, CAST(b AS INT) AS id_equipo_subcampeon,
        season AS temporada, 'sitio' AS fuente, season AS periodo FROM (SELECT *,
        CASE season % 3 WHEN 0 THEN 'fc súpplier#' || lpad(CAST(a AS VARCHAR), 9, '0') WHEN 1 THEN 'Supplier#' || lpad(CAST(a AS VARCHAR), 9, '0') ELSE ' s' || a END AS ca,
        CASE season % 3 WHEN 0 THEN 'fc súpplier#' || lpad(CAST(b AS VARCHAR), 9, '0') WHEN 1 THEN 'Supplier#' || lpad(CAST(b AS VARCHAR), 9, '0') ELSE ' s' || b END AS cb FROM champ)""",
    "dim": """SELECT c.id_equipo, c.nombre_equipo, t.alias_equipo, t.url_equipo, e.estadio, e.capacidad, e.aforo, v.valor_total AS valor_total_actual,
        v.valor_medio AS valor_medio_actual, v.jugadores_en_plantilla AS jugadores_plantilla_actual, v.edad_promedio AS edad_promedio_actual,
        v.extranjeros AS extranjeros_actual, v.temporada AS temporada_ultima_valoracion FROM cat c LEFT JOIN md_equipos t USING (id_equipo)
        LEFT JOIN md_estadios e USING (id_equipo) LEFT JOIN (SELECT * FROM hm_valor QUALIFY row_number() OVER (PARTITION BY id_equipo ORDER BY temporada DESC) = 1) v USING (id_equipo)""",
    "ft_temporada": """SELECT h.id_clasificacion, h.id_equipo, d.nombre_equipo, d.alias_equipo, h.temporada, h.tipo_tabla, h.posicion, h.partidos_jugados, h.partidos_ganados,
        h.partidos_empatados, h.partidos_perdidos, h.goles_favor, h.goles_contra, h.diferencia_goles, h.puntos, v.valor_total, v.valor_medio, h.periodo
        FROM hm_tablas h LEFT JOIN hm_valor v USING (id_equipo, temporada) LEFT JOIN dim d USING (id_equipo)""",
    "ft_acumulado": """SELECT sha256(id_equipo || '-' || temporada) AS id_acumulado, a.id_equipo, d.nombre_equipo, d.alias_equipo, a.temporada, a.torneos_disputados,
        total_pj, total_pg, total_pe, total_pp, total_goles_favor, total_goles_contra, CAST(total_goles_favor - total_goles_contra AS INT) AS total_diferencia_goles,
        total_puntos, v.valor_total, v.valor_medio, temporada AS periodo FROM (SELECT id_equipo, temporada, CAST(count(*) AS INT) AS torneos_disputados,
        CAST(sum(partidos_jugados) AS INT) AS total_pj, CAST(sum(partidos_ganados) AS INT) AS total_pg, CAST(sum(partidos_empatados) AS INT) AS total_pe,
        CAST(sum(partidos_perdidos) AS INT) AS total_pp, CAST(sum(goles_favor) AS INT) AS total_goles_favor, CAST(sum(goles_contra) AS INT) AS total_goles_contra,
        CAST(sum(puntos) AS INT) AS total_puntos FROM hm_tablas GROUP BY 1, 2) a LEFT JOIN hm_valor v USING (id_equipo, temporada) LEFT JOIN dim d USING (id_equipo)""",
    "ft_detalle": "SELECT p.id_partido, p.id_equipo_local, l.nombre_equipo AS nombre_equipo_local, l.alias_equipo AS alias_equipo_local, p.id_equipo_visitante, "
                  "v.nombre_equipo AS nombre_equipo_visitante, v.alias_equipo AS alias_equipo_visitante, p.temporada, p.fecha_partido, p.marcador, p.goles_local, "
                  "p.goles_visitante, s.fecha_stats, " + ", ".join(f"s.{c}" for c in [*STAT_VALUES, *SHARE_VALUES])
                  + ", p.url, p.fuente_partido, p.periodo FROM hm_partidos p LEFT JOIN hm_stats s USING (id_partido) "
                    "LEFT JOIN dim l ON p.id_equipo_local = l.id_equipo LEFT JOIN dim v ON p.id_equipo_visitante = v.id_equipo",
    "ft_plantillas": """SELECT h.id_plantilla_equipo, h.id_equipo, d.nombre_equipo, d.alias_equipo, h.id_jugador, h.id_tm, m.jugador, h.temporada, h.numero_camiseta,
        h.posicion, h.fecha_fichaje, m.edad, m.nacionalidad_principal, m.segunda_nacionalidad, m.altura, m.pie, m.valor_mercado, m.foto_url, h.periodo
        FROM hm_plantillas h JOIN md_plantillas m USING (id_jugador) LEFT JOIN dim d USING (id_equipo)""",
    "ft_entrenadores": """SELECT h.id_entrenador_equipo, h.id_equipo, d.nombre_equipo, d.alias_equipo, h.id_entrenador, m.entrenador, m.edad, m.nacionalidad_principal,
        m.segunda_nacionalidad, h.temporada, h.fecha_inicio, h.fecha_termino, h.tiempo_en_cargo, h.partidos, h.ppp, h.entrenador_activo, h.periodo
        FROM hm_entrenadores h JOIN md_entrenadores m USING (id_entrenador) LEFT JOIN dim d USING (id_equipo)""",
    "ft_valor": """SELECT h.id_valoracion_equipo, h.id_equipo, d.nombre_equipo, d.alias_equipo, h.temporada, h.jugadores_en_plantilla, h.edad_promedio, h.extranjeros,
        h.valor_medio, h.valor_total, h.periodo FROM hm_valor h LEFT JOIN dim d USING (id_equipo)""",
    "ft_jugadores": "SELECT sha256(id_jugador || '-' || id_equipo || '-' || temporada) AS id_estadistica_jugador, a.id_jugador, a.id_tm, a.jugador, m.foto_url, a.id_equipo, "
                    "d.nombre_equipo, d.alias_equipo, a.temporada, " + ", ".join(f"a.{c}" for c in _PLAYER_SUMS)
                    + ", a.ppp, a.goles, CASE WHEN a.goles > 0 THEN CAST(a.minutos_jugados // a.goles AS INT) ELSE 0 END AS min_por_gol, a.datos_disponibles, p.posicion, "
                      "m.nacionalidad_principal, a.periodo FROM (SELECT id_jugador, id_tm, jugador, id_equipo, temporada, periodo, "
                    + ", ".join(_sum(c, c) for c in _PLAYER_SUMS)
                    + ", avg(ppp) AS ppp, CAST(sum(goles) + sum(penaltis_anotados) AS INT) AS goles, bool_or(datos_disponibles) AS datos_disponibles "
                      "FROM hm_jugadores GROUP BY 1, 2, 3, 4, 5, 6) a JOIN md_plantillas m USING (id_jugador) "
                      "LEFT JOIN hm_plantillas p USING (id_jugador, id_equipo, temporada) LEFT JOIN dim d USING (id_equipo)",
    "posiciones": """SELECT id_clasificacion AS id_rendimiento, id_equipo, nombre_equipo, alias_equipo, temporada, tipo_tabla, posicion, partidos_jugados, partidos_ganados,
        partidos_empatados, partidos_perdidos, goles_favor, goles_contra, diferencia_goles, puntos, valor_total, valor_medio, CAST(NULL AS INT) AS torneos_disputados
        FROM ft_temporada UNION ALL BY NAME SELECT id_acumulado AS id_rendimiento, id_equipo, nombre_equipo, alias_equipo, temporada, 'Acumulado' AS tipo_tabla,
        CAST(row_number() OVER (PARTITION BY temporada ORDER BY total_puntos DESC, total_diferencia_goles DESC, total_goles_favor DESC, id_equipo) AS INT) AS posicion,
        total_pj AS partidos_jugados, total_pg AS partidos_ganados, total_pe AS partidos_empatados, total_pp AS partidos_perdidos, total_goles_favor AS goles_favor,
        total_goles_contra AS goles_contra, total_diferencia_goles AS diferencia_goles, total_puntos AS puntos, valor_total, valor_medio, torneos_disputados FROM ft_acumulado""",
    "partidos_equipo": None,
    "stats_vw": f"""SELECT * EXCLUDE (nacionalidad_principal, periodo, tarjeta_amarilla_roja), tarjeta_amarilla_roja AS segunda_amarilla, {_XI} AS posicion_xi
        FROM ft_jugadores WHERE datos_disponibles""",
    "plantillas_vw": """SELECT id_plantilla_equipo, id_equipo, nombre_equipo, alias_equipo, id_jugador, jugador, temporada, numero_camiseta, posicion, fecha_fichaje,
        edad AS edad_actual, edad - (2024 - temporada) AS edad_historica, nacionalidad_principal, segunda_nacionalidad, altura, pie, valor_mercado FROM ft_plantillas""",
    "feats": f"""SELECT * EXCLUDE (datos_disponibles, nacionalidad_principal, periodo), {_XI} AS posicion_xi, goles / minutos_jugados * 90 AS goles_p90,
        asistencias / minutos_jugados * 90 AS asistencias_p90, (goles + asistencias) / minutos_jugados * 90 AS participacion_p90,
        -(tarjetas_amarillas / minutos_jugados * 90) AS amarillas_p90, -(tarjetas_rojas / minutos_jugados * 90) AS rojas_p90,
        -(tarjeta_amarilla_roja / minutos_jugados * 90) AS segunda_am_p90, -(goles_en_contra / minutos_jugados * 90) AS gc_p90,
        partidos_imbatido / minutos_jugados * 90 AS pi_p90, CAST(minutos_jugados AS DOUBLE) AS score_ml FROM ft_jugadores WHERE minutos_jugados >= 300""",
    "score": """SELECT md5(id_jugador || '_' || id_equipo || '_' || temporada) AS id_score_ml, *, CASE WHEN score_100 >= 50 THEN 2 ELSE 1 END AS nivel_num,
        CASE WHEN score_100 >= 50 THEN 'Bueno' ELSE 'Regular' END AS nivel FROM (SELECT *, 0.5::DOUBLE AS var_explicada,
        CASE WHEN max(score_ml) OVER w > min(score_ml) OVER w THEN (score_ml - min(score_ml) OVER w) / (max(score_ml) OVER w - min(score_ml) OVER w) * 100 ELSE 50.0 END AS score_100
        FROM feats WINDOW w AS (PARTITION BY posicion_xi))""",
    "slots": None,
    "slot_ranks": "SELECT *, CAST(row_number() OVER (PARTITION BY id_formacion, posicion_xi ORDER BY orden) AS INT) AS slot_rank FROM slots",
    "score_vw": """SELECT r.* EXCLUDE (player_rank), s.slot, s.orden, s.x_coord, s.y_coord FROM (SELECT x.*, f.id_formacion,
        dense_rank() OVER (PARTITION BY temporada, f.id_formacion, x.posicion_xi, id_equipo ORDER BY score_100 DESC, id_jugador) AS player_rank FROM
        (SELECT id_score_ml, id_jugador, id_tm, jugador, foto_url, id_equipo, nombre_equipo, alias_equipo, temporada, posicion,
         CASE posicion_xi WHEN 'POR' THEN 'Portero' WHEN 'DFC' THEN 'Defensa Central' WHEN 'LD' THEN 'Lateral Derecho' WHEN 'LI' THEN 'Lateral Izquierdo'
          WHEN 'MCD' THEN 'Mediocampista Defensivo' WHEN 'MC' THEN 'Mediocampista Central' WHEN 'MCO' THEN 'Mediocampista Ofensivo' WHEN 'EI' THEN 'Extremo Izquierdo'
          WHEN 'ED' THEN 'Extremo Derecho' WHEN 'DC' THEN 'Delantero Centro' ELSE posicion_xi END AS posicion_xi_nombre, posicion_xi, partidos_jugados, titularidades,
         minutos_jugados, goles, asistencias, goles + asistencias AS participaciones_gol, ppp, tarjetas_amarillas, tarjeta_amarilla_roja AS segunda_amarilla, tarjetas_rojas,
         entrada_suplente, salida_suplente, min_por_gol, goles_en_contra, partidos_imbatido, round(goles_p90, 3) AS goles_p90, round(asistencias_p90, 3) AS asistencias_p90,
         round(participacion_p90, 3) AS participacion_p90, round(gc_p90, 3) AS gc_p90, round(pi_p90, 3) AS pi_p90, round(score_ml, 4) AS score_ml,
         round(score_100, 2) AS score_100, round(var_explicada * 100, 1) AS varianza_explicada_pct, nivel_num, nivel FROM score) x
        JOIN (SELECT DISTINCT id_formacion, posicion_xi FROM slots) f USING (posicion_xi)) r
        JOIN slot_ranks s ON s.id_formacion = r.id_formacion AND s.posicion_xi = r.posicion_xi AND s.slot_rank = r.player_rank""",
}

_PRESENT_STATS = {c.rsplit("_", 1)[0] for c in STAT_VALUES}
_TEAM_COLUMNS = ["pases", "pases_precisos", "tarjetas_amarillas", "duelos_ganados", "entradas", "regates_realizados"]


def _side(s: str, o: str, role: str) -> str:
    gf, gc = f"goles_{s}", f"goles_{o}"
    cols = ", ".join(f"{c}_{s} AS {c}" for c in _TEAM_COLUMNS)
    return f"""SELECT id_partido, temporada, fecha_partido, fecha_stats, CASE WHEN marcador = 'sin informacion' THEN 1 ELSE 0 END AS partido_sin_info,
        CASE WHEN marcador = 'sin informacion' THEN 'Sin jugar/Aplazado' ELSE 'Disputado' END AS estado_partido, url, fuente_partido, '{role}' AS rol_equipo,
        id_equipo_{s} AS id_equipo, nombre_equipo_{s} AS nombre_equipo, alias_equipo_{s} AS alias_equipo, id_equipo_{o} AS id_rival, {gf} AS goles_favor,
        {gc} AS goles_contra, {gf} - {gc} AS diferencia_goles, CASE WHEN marcador = 'sin informacion' THEN 'S/A' WHEN {gf} > {gc} THEN 'G' WHEN {gf} = {gc} THEN 'E'
        ELSE 'P' END AS resultado, posesion_{s}_pct AS posesion_pct, tiros_totales_{s} AS tiros_totales, disparos_puerta_{s} AS disparos_puerta,
        CASE WHEN tiros_totales_{s} > 0 THEN round(disparos_puerta_{s} / tiros_totales_{s}, 4) END AS precision_tiro_pct,
        CASE WHEN tiros_totales_{s} > 0 THEN round({gf} / tiros_totales_{s}, 4) END AS conversion_gol_pct, {cols},
        {"pases_precisos_" + s + "_pct"} AS pases_precisos_pct FROM ft_detalle"""


CTES["partidos_equipo"] = _side("local", "visitante", "LOCAL") + " UNION ALL " + _side("visitante", "local", "VISITANTE")


def _slots() -> str:
    from matchloom.functions.fixed import SLOTS

    return f"SELECT * FROM (VALUES {', '.join(map(str, SLOTS))}) AS t(id_formacion, slot, orden, posicion_xi, x_coord, y_coord)"


CTES["slots"] = _slots()


def league_sql(final: str) -> str:
    """The statement preceded by the entities it needs, and no others."""
    needed: set[str] = set()
    pending = [final]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                pending.append(CTES[name])
    parts = [f"{name} AS ({body})" for name, body in CTES.items() if name in needed]
    return f"WITH {', '.join(parts)} {final}" if parts else final
