"""Silver entities: raw rows of both sources resolved against the team catalogue.

Every job returns (table, rejects). Unmatched rows go to the rejects with a reason. `as_of` stands for the
load time and defaults to the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, fixed, jsonx, measures, text
from ..operators import filters, joins, ranking, shape

NO_CATALOG = "SIN_MATCH_CATALOGO"
NO_DIMENSION = "SIN_MATCH_DIMENSION"
NO_PLAYER = "SIN_MATCH_MD_PLANTILLAS"
Split = tuple[DataFrame, DataFrame]

STATS = [f"{stem}_{side}" for _, _, stem, _ in fixed.MATCH_STATS for side in fixed.SIDES]
STATS_WITH_PCT = [f"{stem}_{side}" for _, _, stem, share in fixed.MATCH_STATS if share for side in fixed.SIDES]
RAW_STATS = {f"{es}_{side}": f"{stem}_{side}" for es, _, stem, _ in fixed.MATCH_STATS for side in fixed.SIDES}
TWIN_STATS = {f"{es}_{side}": (f"{en}_{side}" if en else None) for es, en, _, _ in fixed.MATCH_STATS for side in fixed.SIDES}
MATCH_STATS_SCHEMA = {
    "id_partido": "string", "id_equipo_local": "int", "id_equipo_visitante": "int", "temporada": "int",
    "estado": "string", "marcador": "string", "goles_local": "int", "goles_visitante": "int", "url": "string",
    "fecha_stats": "date",
    **{s: "int" for s in STATS if s not in fixed.STATS_NOT_PUBLISHED},
    **{f"{s}_pct": "double" for s in STATS_WITH_PCT},
    "fecha_carga": "timestamp", "fuente": "string", "periodo": "int",
}
PLAYER_STATS = ["partidos_jugados", "titularidades", "ppp", "goles", "asistencias", "tarjetas_amarillas",
                "tarjeta_amarilla_roja", "tarjetas_rojas", "entrada_suplente", "salida_suplente",
                "penaltis_anotados", "goles_en_contra", "partidos_imbatido", "min_por_gol", "minutos_jugados"]


def _now(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def _by_row(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in columns or df.columns]))


def one_per(df: DataFrame, keys: list[str], order: ranking.Order = ()) -> DataFrame:
    """One row per key with a fixed choice among equal rows."""
    present = [(c, d) for c, d in order if c in df.columns]
    return ranking.top_row_per_key(_by_row(df), keys, [*present, ("_tie", "asc")]).drop("_tie")


def _team_names(catalog: DataFrame, source: str) -> DataFrame:
    named = catalog.select(text.join_name(source).alias("_team"), "id_equipo").filter(F.col("_team").isNotNull())
    return named.groupBy("_team").agg(F.min("id_equipo").alias("id_equipo"))


def with_team(raw: DataFrame, catalog: DataFrame, club: str = "club", source: str = "nombre_transfermarkt") -> Split:
    keyed = raw.withColumn("_club", text.join_name(club))
    ok, missed = joins.match_split(keyed, _team_names(catalog, source), {"_club": "_team"}, NO_CATALOG, ["id_equipo"])
    return ok.drop("_club"), missed.drop("_club")


def _translate_countries(df: DataFrame, countries: DataFrame | None) -> DataFrame:
    for c in ("nacionalidad_principal", "segunda_nacionalidad"):
        if countries is None:
            df = df.withColumn(c, text.default_if_placeholder(F.trim(c)))
        else:
            df = joins.lookup(df, countries, c, "nombre_raw", "nombre_es")
    return df


def team_catalog(raw: DataFrame, as_of: Column | None = None) -> Split:
    schema = {"id_equipo": "int", "nombre_equipo": "string", "nombre_fotmob": "string",
              "nombre_transfermarkt": "string", "alias": "string", "nombre_fotmob_clasificacion": "string",
              "nombre_fotmob_clas_alt": "string", "fecha_carga": "timestamp", "periododia": "int"}
    columns = [c for c in schema if c not in ("fecha_carga", "periododia")]
    rows = shape.add_control_columns(shape.select_existing(raw, columns), _now(as_of))
    return filters.split_null_key(shape.cast_schema(rows, schema), "id_equipo")


def teams(raw: DataFrame, catalog: DataFrame, as_of: Column | None = None) -> Split:
    rows = one_per(raw.select("equipo", "url", "fuente").withColumn("equipo_raw", F.lower("equipo")), ["equipo_raw"])
    dim = (catalog.filter(F.trim("nombre_fotmob") != "")
           .select(text.join_name("nombre_fotmob").alias("_team"), "id_equipo", "nombre_equipo", "alias"))
    keyed = rows.withColumn("_name", F.trim("equipo_raw"))
    ok, missed = joins.match_split(keyed, one_per(dim, ["_team"], [("id_equipo", "asc")]), {"_name": "_team"}, NO_CATALOG,
                                   ["id_equipo", "nombre_equipo", "alias"])
    table = ok.select("id_equipo", "nombre_equipo", F.col("alias").alias("alias_equipo"), "equipo_raw",
                      F.col("url").alias("url_equipo"), F.col("fuente").alias("fuente_equipo"))
    return shape.add_control_columns(table, _now(as_of)), missed.select("equipo", "url", "fuente", filters.REASON)


def stadiums(raw: DataFrame, catalog: DataFrame, as_of: Column | None = None) -> Split:
    rows = one_per(raw.select("club", "estadio", "capacidad", "aforo", "fuente", *_optional(raw, "fecha_carga")),
                   ["club"], [("fecha_carga", "desc")])
    ok, missed = with_team(rows.drop("fecha_carga"), catalog)
    blank = fixed.ZERO_WORDS
    table = ok.select(
        text.surrogate_key("id_equipo", text.join_name("estadio")).alias("id_estadio"), "id_equipo", "estadio",
        text.default_if_placeholder("capacidad", blank).alias("capacidad"),
        text.default_if_placeholder("aforo", blank).alias("aforo"), F.col("fuente").alias("fuente_estadio"))
    valid, invalid = filters.split_rule(table, F.col("estadio") != fixed.NO_STADIUM)
    return (shape.add_control_columns(valid, _now(as_of)),
            missed.unionByName(invalid, allowMissingColumns=True))


def _optional(df: DataFrame, *cols: str) -> list[str]:
    return [c for c in cols if c in df.columns]


def players(raw: DataFrame, countries: DataFrame | None = None, as_of: Column | None = None) -> Split:
    """One row per player with, per column, the value of the latest season where it is filled."""
    fields = ["jugador", "fecha_nacimiento", "nacionalidad", "altura", "pie", "valor_mercado", "fuente", "id_tm", "foto_url"]
    now = _now(as_of)
    # Latest season first, then a fixed choice among rows of one season, packed into one number.
    season = F.coalesce(F.col("temporada").try_cast("int"), F.lit(0)).cast("bigint")
    tie = F.pmod(F.xxhash64(*[F.col(c) for c in fields]), F.lit(1 << 32))
    ranked = raw.select(*fields, (F.shiftleft(-season, 32) + tie).alias("_rank"))
    merged = ranking.latest_non_blank(ranked, F.coalesce("id_tm", "jugador"), [("_rank", "asc")], fields)
    born = dates.birth_date("fecha_nacimiento")
    rows = merged.select(
        text.player_key("id_tm", "jugador").alias("id_jugador"), "id_tm", "jugador",
        dates.age(born, now).alias("edad"),
        text.nth_item("nacionalidad", 1).alias("nacionalidad_principal"),
        text.nth_item("nacionalidad", 2).alias("segunda_nacionalidad"),
        text.height("altura", 0.0).alias("altura"),
        text.default_if_placeholder("pie", [""]).alias("pie"),
        text.money("valor_mercado").alias("valor_mercado"), "foto_url", F.col("fuente").alias("fuente_plantilla"))
    table = shape.add_control_columns(_translate_countries(rows, countries), now)
    return filters.split_null_key(table, "id_jugador")


def squads(raw: DataFrame, catalog: DataFrame, players_dim: DataFrame, positions: DataFrame | None = None,
           as_of: Column | None = None, tasks: int | None = None) -> Split:
    """One row per team, season and player. Rows of a player are alike and compress well, so a task cut by bytes can hold more of them than
    it can sort in memory: `tasks` deals them to so many tasks, where their number is known."""
    columns = ["club", "temporada", "jugador", "numero", "posicion", "fecha_fichaje", "fuente", "id_tm"]
    # Rows of a name move together: they are alike, so they compress well side by side. Rows without a name go by their club.
    near = F.coalesce(F.nullif(F.trim("jugador"), F.lit("")), "club")
    to = [tasks] if tasks else []
    given = shape.select_or_null(raw, [*columns, *_optional(raw, "fecha_carga")])
    # The hash of a row, which does not compress, is added after the move.
    given = _by_row(given.withColumn("_near", near).repartition(*to, "_near"), given.columns)
    latest = [("fecha_carga", "desc")] if "fecha_carga" in given.columns else []
    rows = ranking.top_row_per_key(given, ["_near", "jugador", "club", "temporada", "numero"], [*latest, ("_tie", "asc")])
    with_id, no_team = with_team(rows.select(*columns), catalog)
    # Players meet by the text under the hash, a fraction of its size.
    keyed = with_id.withColumn("_pk", text.player_word("id_tm", "jugador"))
    dim = players_dim.select(text.player_word("id_tm", "jugador").alias("_pd"), "id_jugador")
    dim = (dim.repartition(*to, "_pd") if to else dim).groupBy("_pd").agg(F.min("id_jugador").alias("id_jugador"))
    no_player = joins.match_split(keyed, dim, {"_pk": "_pd"}, NO_DIMENSION)[1].drop("_pk")
    ready = keyed.withColumn("_dated", dates.date_or_null("fecha_fichaje"))
    if positions is None:
        ready = ready.withColumn("posicion", text.position_name("posicion"))
    else:
        ready = joins.lookup(ready, positions, "posicion", "nombre_raw", "nombre_es", fixed.NO_INFO)
    if to:
        ready = ready.select("id_equipo", "id_tm", "temporada", "numero", "posicion", "_dated", "fuente", "_pk").repartition(*to, "_pk")
    season = F.col("temporada").try_cast("int")

    def of(some: DataFrame, person: str) -> DataFrame:
        """First row per team, season and player; `person` is the column by which rows of a player lie together."""
        found = ready.join(some.drop("_alone"), F.col("_pk") == F.col("_pd"))
        table = found.select(
            text.surrogate_key("id_equipo", "id_jugador", "temporada", text.join_name("posicion")).alias("id_plantilla_equipo"),
            "id_equipo", "id_jugador", "id_tm", season.alias("temporada"),
            text.default_if_placeholder("numero").alias("numero_camiseta"), text.title("posicion").alias("posicion"),
            F.col("_dated").alias("fecha_fichaje"), F.col("fuente").alias("fuente_plantilla"),
            _now(as_of).alias("fecha_carga"), season.alias("periodo"), "_pk")
        # By person first: rows of a player stay side by side, so that their long key is stored and moved once.
        return ranking.top_row_per_key(table, [person, "id_equipo", "temporada"],
                                       [("id_plantilla_equipo", "asc"), ("numero_camiseta", "asc")]).drop("_pk")

    # Rows of a player with one text already lie together after the join; only players of several texts move again.
    alone = F.count(F.lit(1)).over(Window.partitionBy("id_jugador")) == 1
    dim = dim.withColumn("_alone", alone)
    final = of(dim.filter("_alone"), "_pk").unionByName(of(dim.filter("not _alone"), "id_jugador"))
    rejects = no_team.unionByName(no_player.select(*columns, filters.REASON))
    return final, rejects


def coaches(raw: DataFrame, countries: DataFrame | None = None, as_of: Column | None = None) -> Split:
    now = _now(as_of)
    latest = one_per(raw.withColumn("temporada", F.col("temporada").try_cast("int")), ["entrenador"], [("temporada", "desc")])
    born = dates.birth_date("fecha_nacimiento")
    rows = latest.select(
        text.surrogate_key(F.lower("entrenador"), born).alias("id_entrenador"), "entrenador",
        dates.age(born, now).alias("edad"), text.nth_item("nacionalidad", 1).alias("nacionalidad_principal"),
        text.nth_item("nacionalidad", 2).alias("segunda_nacionalidad"), F.col("fuente").alias("fuente_entrenador"))
    table = shape.add_control_columns(_translate_countries(rows, countries), now)
    return filters.split_null_key(table, "entrenador")


def coach_spells(raw: DataFrame, catalog: DataFrame, coaches_dim: DataFrame, as_of: Column | None = None) -> Split:
    columns = ["club", "temporada", "entrenador", "comienzo", "salida", "tiempo_en_cargo", "partidos", "ppp", "fuente"]
    rows = one_per(shape.select_or_null(raw, [*columns, *_optional(raw, "fecha_carga")]),
                   ["club", "entrenador", "comienzo"], [("fecha_carga", "desc")])
    with_id, no_team = with_team(rows.select(*columns), catalog)
    keyed = with_id.withColumn("_name", text.norm_name("entrenador"))
    dim = (coaches_dim.select(text.norm_name("entrenador").alias("_coach"), "id_entrenador")
           .groupBy("_coach").agg(F.min("id_entrenador").alias("id_entrenador")))
    ok, no_coach = joins.match_split(keyed, dim, {"_name": "_coach"}, NO_DIMENSION, ["id_entrenador"])
    start = dates.date_or_null("comienzo")
    days = F.when(text.is_placeholder("tiempo_en_cargo", fixed.TEXT_BLANKS), F.lit(fixed.NO_INFO)).otherwise(
        text.strip_unit("tiempo_en_cargo"))
    table = ok.select(
        text.surrogate_key("id_equipo", "id_entrenador", "comienzo").alias("id_entrenador_equipo"), "id_equipo",
        "id_entrenador", dates.season_of(start).alias("temporada"), start.alias("fecha_inicio"),
        dates.date_or_null("salida").alias("fecha_termino"), days.alias("tiempo_en_cargo"),
        text.number_or_zero("partidos").try_cast("int").alias("partidos"),
        text.number_or_zero("ppp").try_cast("decimal(10,4)").alias("ppp"),
        text.is_active("salida").alias("entrenador_activo"), F.col("fuente").alias("fuente_entrenador"),
        _now(as_of).alias("fecha_carga"), dates.season_of(start).alias("periodo"))
    return table, no_team.unionByName(no_coach.select(*columns, filters.REASON))


def team_values(raw: DataFrame, catalog: DataFrame, as_of: Column | None = None) -> Split:
    columns = ["club", "temporada", "jugadores_en_plantilla", "edad_promedio", "extranjeros", "valor_medio", "valor_total", "fuente"]
    rows = one_per(raw.select(*columns, *_optional(raw, "fecha_carga")), ["club", "temporada"], [("fecha_carga", "desc")])
    ok, missed = with_team(rows.select(*columns), catalog)
    season = F.col("temporada").try_cast("int")
    table = ok.select(
        text.surrogate_key("id_equipo", "temporada").alias("id_valoracion_equipo"), "id_equipo", season.alias("temporada"),
        text.number_or_zero("jugadores_en_plantilla").try_cast("int").alias("jugadores_en_plantilla"),
        text.number_or_zero("edad_promedio").try_cast("double").alias("edad_promedio"),
        text.number_or_zero("extranjeros").try_cast("int").alias("extranjeros"),
        text.money("valor_medio").alias("valor_medio"), text.money("valor_total").alias("valor_total"),
        F.col("fuente").alias("fuente_valoracion"), _now(as_of).alias("fecha_carga"), season.alias("periodo"))
    return table, missed


def matches(raw: DataFrame, catalog: DataFrame, as_of: Column | None = None) -> Split:
    columns = ["temporada", "fecha", "marcador", "url", "fuente", "local", "visitante", "fecha_carga"]
    rows = one_per(shape.select_or_null(raw, columns), ["temporada", "url"], [("fecha_carga", "desc")])
    names = _team_names(catalog, "nombre_fotmob")
    keyed = rows.withColumn("_home", text.join_name("local")).withColumn("_away", text.join_name("visitante"))
    both = joins.join_roles(keyed, names, "_team", {"_home": {"id_equipo": "id_equipo_local"},
                                                    "_away": {"id_equipo": "id_equipo_visitante"}})
    ok, missed = filters.split_rule(both, F.col("id_equipo_local").isNotNull() & F.col("id_equipo_visitante").isNotNull(), NO_CATALOG)
    season = F.col("temporada").try_cast("int")
    table = ok.select(
        text.surrogate_key("temporada", "url").alias("id_partido"), "id_equipo_local", "id_equipo_visitante",
        season.alias("temporada"), dates.match_date("fecha", "temporada").alias("fecha_partido"),
        text.valid_score("marcador").alias("marcador"), text.score_side("marcador", 1).alias("goles_local"),
        text.score_side("marcador", 2).alias("goles_visitante"), "url", F.col("fuente").alias("fuente_partido"),
        F.coalesce(F.col("fecha_carga").try_cast("timestamp"), _now(as_of)).alias("fecha_carga"), season.alias("periodo"))
    return table, missed.select(*columns, filters.REASON)


def _stat_rules(date: Column | None):
    taken = {"id_partido", "id_equipo_local", "id_equipo_visitante", "temporada", "marcador", "url", "fuente", "periodo", "fecha_carga"}
    return [
        (lambda n: n in taken, lambda n: F.col(n)),
        (lambda n: n == "estado", lambda n: F.lit(None).cast("string")),
        (lambda n: n == "goles_local", lambda n: text.score_side("marcador", 1, 0)),
        (lambda n: n == "goles_visitante", lambda n: text.score_side("marcador", 2, 0)),
        (lambda n: n == "fecha_stats", lambda n: date),
        (lambda n: n.endswith("_pct"), lambda n: text.pct(n.removesuffix("_pct"))),
        (lambda n: True, lambda n: text.first_int(n).try_cast("int")),
    ]


def _match_stats(raw: DataFrame, matches_table: DataFrame, date, as_of: Column | None) -> DataFrame:
    wanted = ["fuente", "marcador", "url", "fecha", *RAW_STATS]
    named = shape.coalesce_dual_columns(shape.lower_headers(raw), [*wanted, "fecha_carga"], TWIN_STATS)
    rows = one_per(shape.rename_columns(named, RAW_STATS), ["url"], [("fecha_carga", "desc")]).drop("fecha_carga")
    games = matches_table.select("id_partido", "id_equipo_local", "id_equipo_visitante", "temporada", "url")
    joined = rows.join(games, "url", "inner").withColumn("periodo", F.col("temporada")).withColumn("fecha_carga", _now(as_of))
    return shape.project_by_rules(joined, MATCH_STATS_SCHEMA, _stat_rules(date))


def match_stats(raw: DataFrame, matches_table: DataFrame, as_of: Column | None = None) -> Split:
    """Statistics of known matches; rows whose URL is not a known match are rejected."""
    table = _match_stats(raw, matches_table, dates.date_or_null("fecha"), as_of)
    missed = joins.missing_from(shape.lower_headers(raw).select("url").distinct(), matches_table, "url")
    return table, missed.withColumn(filters.REASON, F.lit(NO_DIMENSION))


def patch_match_stats(raw: DataFrame, matches_table: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The same statistics from files with long dates, with missing numbers as zero."""
    table = _match_stats(raw, matches_table, dates.match_date("fecha", "temporada"), as_of)
    return shape.zero_fill_by_type(table, MATCH_STATS_SCHEMA)


STANDING_KEYS = ["posicion", "equipo", "partidos_jugados", "partidos_ganados", "partidos_empatados", "partidos_perdidos",
                 "goles_favor", "goles_contra", "diferencia_goles", "puntos"]


def standings(raw: DataFrame, catalog: DataFrame, data: str = "data", as_of: Column | None = None) -> Split:
    rows = jsonx.explode_tables(raw, data, STANDING_KEYS)
    numbers = {k: "int" for k in STANDING_KEYS if k != "equipo"}
    typed = rows.select("fuente", F.col("temporada").try_cast("int").alias("temporada"), "tipo_tabla", "equipo",
                        *[F.col(k).try_cast(t).alias(k) for k, t in numbers.items()])
    found = joins.resolve_by_priority(typed, catalog, "equipo", "id_equipo", fixed.CATALOG_NAME_PRIORITY)
    ok, missed = filters.split_rule(found, F.col("id_equipo").isNotNull(), NO_CATALOG)
    table = ok.select(
        text.surrogate_key("temporada", "tipo_tabla", "id_equipo").alias("id_clasificacion"), "id_equipo", "temporada",
        "tipo_tabla", "posicion",
        measures.games_or_computed("partidos_jugados", "partidos_ganados", "partidos_empatados", "partidos_perdidos").alias("partidos_jugados"),
        "partidos_ganados", "partidos_empatados", "partidos_perdidos", "goles_favor", "goles_contra",
        measures.goal_diff("goles_favor", "goles_contra").alias("diferencia_goles"),
        measures.points_or_computed("puntos", "partidos_ganados", "partidos_empatados").alias("puntos"),
        _now(as_of).alias("fecha_carga"), F.col("temporada").alias("periodo"))
    return table, missed.drop("id_equipo")


def champions(raw: DataFrame, catalog: DataFrame, as_of: Column | None = None) -> Split:
    first = joins.join_any_name(raw.select("temporada", "campeon", "subcampeon", "fuente"), catalog, "campeon",
                                fixed.CHAMPION_NAMES, "id_equipo", "id_equipo_campeon")
    both = joins.join_any_name(first, catalog, "subcampeon", fixed.CHAMPION_NAMES, "id_equipo", "id_equipo_subcampeon")
    season = F.col("temporada").try_cast("int")
    table = both.select(
        text.surrogate_key("temporada", "campeon", "subcampeon", sep="|").alias("id_campeonato"), "id_equipo_campeon",
        "id_equipo_subcampeon", season.alias("temporada"), "fuente", _now(as_of).alias("fecha_carga"), season.alias("periodo"))
    unknown = both.filter(F.col("id_equipo_campeon").isNull() | F.col("id_equipo_subcampeon").isNull())
    return table, unknown.select("temporada", "campeon", "subcampeon", "fuente", F.lit(NO_CATALOG).alias(filters.REASON))


def player_stats(raw: DataFrame, catalog: DataFrame, players_dim: DataFrame, as_of: Column | None = None) -> Split:
    columns = ["id_tm", "jugador", "club", "temporada", "foto_url", "competencia", *PLAYER_STATS, "datos_disponibles"]
    rows = shape.select_or_null(raw, columns)
    with_id, no_team = with_team(rows, catalog)
    dim = (filters.non_blank(players_dim.select("id_tm", "id_jugador"), "id_tm")
           .groupBy(F.col("id_tm").alias("_id_tm")).agg(F.min("id_jugador").alias("id_jugador")))
    no_player = joins.match_split(with_id, dim, {"id_tm": "_id_tm"}, NO_PLAYER)[1]
    # Numbers are read before the join, which moves them as numbers.
    ready = with_id.select(
        "id_tm", "jugador", "id_equipo", "temporada", "competencia",
        *[F.col(c).try_cast("double" if c == "ppp" else "int").alias(c) for c in PLAYER_STATS],
        text.bool_or_false("datos_disponibles").alias("datos_disponibles"))
    ok = ready.join(dim, F.col("id_tm") == F.col("_id_tm"))
    season = F.col("temporada").try_cast("int")
    table = ok.select(
        text.surrogate_key("id_tm", "id_equipo", "temporada", text.join_name("competencia")).alias("id_estadistica_jugador"),
        "id_jugador", "id_tm", "jugador", "id_equipo", season.alias("temporada"),
        text.default_if_placeholder("competencia", [""], "Sin información").alias("competencia"),
        *PLAYER_STATS, "datos_disponibles", F.lit("Transfermarkt").alias("fuente"),
        _now(as_of).alias("fecha_carga"), season.alias("periodo"))
    return table, no_team.unionByName(no_player.select(*columns, filters.REASON))


def patch_players(raw: DataFrame) -> DataFrame:
    """Corrections of foot, height and value: latest season per lowered name, at least one field given."""
    rows = shape.select_or_null(raw, ["jugador", "temporada", "pie", "altura", "valor_mercado"])
    fixes = rows.select(
        text.join_name("jugador").alias("jugador"), F.col("temporada").try_cast("int").alias("temporada"),
        F.trim(text.null_if_placeholder("pie", fixed.TEXT_BLANKS)).alias("pie"),
        text.height("altura", None).alias("altura"), text.money("valor_mercado", None).alias("valor_mercado"))
    latest = one_per(fixes.filter(F.col("jugador").isNotNull()), ["jugador"], [("temporada", "desc")])
    return filters.any_not_null(latest, ["pie", "altura", "valor_mercado"]).drop("temporada")


def patch_squads(raw: DataFrame, catalog: DataFrame, players_dim: DataFrame, as_of: Column | None = None, tasks: int | None = None) -> Split:
    """Squads rebuilt by player name; unknown teams and players and further rows of a key are rejected. `tasks` as in `squads`."""
    columns = ["club", "temporada", "jugador", "numero", "posicion", "fecha_fichaje", "fuente"]
    # Rows of a name move together, without their hash, as in `squads`.
    near = F.coalesce(F.nullif(F.trim("jugador"), F.lit("")), "club")
    given = shape.select_or_null(raw, columns).withColumn("_near", near).repartition(*([tasks] if tasks else []), "_near")
    rows = ranking.top_row_per_key(_by_row(given, columns), ["_near", "club", "temporada", "jugador"], [("_tie", "asc")])
    with_id, no_team = with_team(rows.select(*columns), catalog)
    # The hashes travel as bytes, which have the order of their texts.
    dim = players_dim.select(text.join_name("jugador").alias("_player"), text.packed_key("id_jugador").alias("id_jugador")).filter(F.col("_player").isNotNull())
    dim = dim.withColumn("_alone", F.count(F.lit(1)).over(Window.partitionBy("id_jugador")) == 1)
    named = with_id.withColumn("_name", text.join_name("jugador"))
    keyed, no_player = joins.match_split(named, dim, {"_name": "_player"}, "SIN_MATCH_MD_PLANTILLAS", ["id_jugador", "_alone"])
    season = F.col("temporada").try_cast("int")
    place = text.position_name("posicion", fixed.PATCH_POSITION_NAMES)
    key = text.surrogate_key("id_equipo", text.unpacked_key("id_jugador"), "temporada", text.join_name(place))
    table = keyed.select(
        text.packed_key(key).alias("id_plantilla_equipo"),
        "id_equipo", "id_jugador", F.lit(None).cast("string").alias("id_tm"), season.alias("temporada"),
        text.default_if_placeholder("numero").alias("numero_camiseta"), text.title(place).alias("posicion"),
        dates.date_or_null("fecha_fichaje").alias("fecha_fichaje"), F.col("fuente").alias("fuente_plantilla"),
        _now(as_of).alias("fecha_carga"), season.alias("periodo"), "_name", "_alone")
    # Rows of a player with one name lie together after the join by name; only players of several names move again.
    halves = ranking.split_duplicates_near(table, ["id_equipo", "id_jugador", "temporada"],
                                           [("id_plantilla_equipo", "asc"), ("numero_camiseta", "asc")], "_name", "_alone")
    kept, repeated = (half.withColumns({c: text.unpacked_key(c) for c in ("id_plantilla_equipo", "id_jugador")}) for half in halves)
    rejected = no_team.unionByName(no_player.drop("_name"), allowMissingColumns=True)
    return kept, rejected.unionByName(repeated, allowMissingColumns=True)
