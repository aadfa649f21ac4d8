"""League-shaped inputs derived from the supplied commerce tables, and the entities built from them.

Suppliers stand for teams, orders for matches, parts for players, customers for coaches, lineitem for what
happened. The raw frames carry the text forms of the two sources, so that the silver jobs have work to do.
All work grows with the supplied tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.plans import gold, scoring, silver, views
from matchloom.session import dealt, scratch_dir, tasks_of

AS_OF = "2024-06-30 00:00:00"
POSITIONS = ["Goalkeeper", "Centre-Back", "Left-Back", "Right-Back", "Defensive Midfield", "Central Midfield",
             "Attacking Midfield", "Left Midfield", "Right Midfield", "Left Winger", "Right Winger", "Second Striker",
             "Centre-Forward"]


def txt(*parts) -> Column:
    return F.concat(*[(F.lit(p) if isinstance(p, str) else p.cast("string")) for p in parts])


def two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def padded(c: Column) -> Column:
    return F.lpad(c.cast("string"), 9, "0")


# Line items in a task that turns them into texts.
LINES_A_TASK = 100_000
# Squad rows in a task that sorts them.
SQUAD_ROWS_A_TASK = 400_000
# Folders of the tables written so far, per application and input.
_WRITTEN: dict[tuple[str, str, str], str] = {}
# Score rows over stored features, per application and input.
_SCORES: dict[tuple[str, str], DataFrame] = {}


class League:
    """Each layer reads the written tables of the layer before, as in a scheduled load. Hashed keys take up half of a table and
    do not compress; one that follows from other columns or that no later table reads is not written."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self.as_of = F.lit(AS_OF).cast("timestamp")

    def stored(self, name: str, build, seasons: bool = True) -> DataFrame:
        """The table `name`, written on first use; histories and facts are partitioned by season. Tables of which only whole ones
        are built (`seasons` false) keep the order of their rows, in which a player's rows lie side by side."""
        key = (self.spark.sparkContext.applicationId, self.sf, name)
        if key not in _WRITTEN:
            path, df = scratch_dir(self.spark), build()
            by = ["temporada"] if seasons and "temporada" in df.columns else []
            # No exchange by season ahead of the write: seasons are few, and each task cuts its rows by season.
            df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
            _WRITTEN[key] = path
        return self.spark.read.parquet(_WRITTEN[key])

    def is_written(self, name: str) -> bool:
        return (self.spark.sparkContext.applicationId, self.sf, name) in _WRITTEN

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf}/{name}.parquet")

    def lines(self, *by: str | Column) -> DataFrame:
        """Line items dealt by key to tasks of bounded size: the few numbers of a line become many texts in the same task, so tasks
        cut by the size of the numbers would have to sort far more than they read."""
        return dealt(self.table("lineitem"), LINES_A_TASK, *by)

    # ---- raw inputs -----------------------------------------------------------------
    @cached_property
    def raw_catalog(self) -> DataFrame:
        key, name = F.col("s_suppkey"), F.col("s_name")
        known = F.col("s_acctbal") >= 1000
        return self.table("supplier").select(
            key.cast("int").alias("id_equipo"), name.alias("nombre_equipo"), txt("FC ", name).alias("nombre_fotmob"),
            F.when(known, txt("Club ", F.replace(name, F.lit("#"), F.lit(" ")))).otherwise(txt("Otro ", key)).alias("nombre_transfermarkt"),
            txt("S", key).alias("alias"), F.replace(name, F.lit("Supplier"), F.lit("Súpplier")).alias("nombre_fotmob_clasificacion"),
            F.when(key % 2 == 0, txt("Sup ", key)).otherwise("").alias("nombre_fotmob_clas_alt"))

    @cached_property
    def match_lines(self) -> DataFrame:
        qty = F.col("l_quantity").cast("int")
        return self.lines("l_orderkey").groupBy("l_orderkey").agg(
            F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi"), F.count_if(qty > 25).alias("gl"),
            F.count_if(qty <= 25).alias("gv"), F.sum(qty).alias("q"))

    @cached_property
    def match_base(self) -> DataFrame:
        """Stored, as matches, their statistics, teams and coaches are all read from it: line items are counted once."""
        return self.stored("match_base", lambda: self.table("orders").join(
            self.match_lines, F.col("o_orderkey") == F.col("l_orderkey")).withColumn("season", F.year("o_orderdate")))

    @staticmethod
    def _score() -> Column:
        return F.when(F.col("o_orderstatus") == "P", "Sin jugar").otherwise(txt(F.col("gl"), " - ", F.col("gv")))

    @cached_property
    def raw_matches(self) -> DataFrame:
        day = F.col("o_orderdate")
        date = (F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "dd-MM-yyyy"))
                .when(F.col("o_orderkey") % 3 == 1, F.date_format(day, "EEEE, MMMM d"))
                .otherwise(F.date_format(day, "EEEE, MMMM d yyyy")))
        return self.match_base.select(
            F.col("season").cast("string").alias("temporada"), date.alias("fecha"), self._score().alias("marcador"),
            txt("https://m/", F.col("o_orderkey")).alias("url"), F.lit("sitio").alias("fuente"),
            txt("FC Supplier#", padded(F.col("lo"))).alias("local"), txt("fc supplier#", padded(F.col("hi"))).alias("visitante"),
            F.lit("2024-06-01 10:00:00").alias("fecha_carga"))

    @cached_property
    def raw_match_stats(self) -> DataFrame:
        q, gl, gv = F.col("q"), F.col("gl"), F.col("gv")
        pairs = {
            ("tiros totales", "total shots"): (gl + q % 7, gv + q % 5),
            ("disparos a puerta", "shots on target"): (gl, gv),
            ("pases", "passes"): (q, q % 97),
            ("pases precisos", "accurate passes"): (txt(q % 50, " (", q % 101, " %)"), txt(q % 40, " (", q % 51, "%)")),
            ("tarjetas amarillas", "yellow cards"): (q % 4, q % 3),
            ("duelos ganados", "duels won"): (q % 31, q % 29),
            ("entradas", "tackles"): (q % 17, q % 13),
            ("aéreo ganado", "aerial duels won"): (txt(q % 9, " (", q % 71, " %)"), txt(q % 8)),
            ("regates realizados", "successful dribbles"): (txt(q % 6), txt(q % 7)),
        }
        early = F.col("season") < 1998
        cols = []
        for (es, en), values in pairs.items():
            for side, value in zip(("Local", "Visitante"), values):
                cols.append(F.when(early, value.cast("string")).alias(f"{es}_{side}"))
                cols.append(F.when(~early, value.cast("string")).alias(f"{en}_{side}"))
        return self.match_base.select(
            txt("https://m/", F.col("o_orderkey")).alias("url"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("fecha"),
            self._score().alias("marcador"), F.lit("sitio").alias("fuente"), *cols,
            txt(30 + q % 40, "%").alias("posesión_local"), txt(70 - q % 40, "%").alias("posesión_visitante"))

    @cached_property
    def table_base(self) -> DataFrame:
        qty = F.col("l_quantity").cast("int")
        half = F.when(F.month("l_shipdate") <= 6, "Apertura").otherwise("Clausura")
        return self.table("lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("season"), half.alias("tipo")).agg(
            F.count(F.lit(1)).alias("pj"), F.count_if(qty > 34).alias("pg"), F.count_if((qty > 17) & (qty <= 34)).alias("pe"),
            F.count_if(qty <= 17).alias("pp"), F.sum(qty % 5).alias("gf"), F.sum(qty % 4).alias("gc"))

    @cached_property
    def raw_standings(self) -> DataFrame:
        key = F.col("l_suppkey")
        team = (F.when(key % 3 == 0, txt("Súpplier#", padded(key))).when(key % 3 == 1, txt("FC Supplier#", padded(key)))
                .otherwise(txt("S", key)))
        points = F.when(F.col("pj") % 5 == 0, F.lit(0)).otherwise(F.col("pg") * 3 + F.col("pe"))
        row = F.struct(
            (F.col("pj") % 20 + 1).alias("posicion"), team.alias("equipo"), F.col("pj").alias("partidos_jugados"),
            F.col("pg").alias("partidos_ganados"), F.col("pe").alias("partidos_empatados"), F.col("pp").alias("partidos_perdidos"),
            F.col("gf").alias("goles_favor"), F.col("gc").alias("goles_contra"), (F.col("gf") - F.col("gc")).alias("diferencia_goles"),
            points.alias("puntos"))
        rows = self.table_base.groupBy("l_suppkey", "season").agg(
            *[F.max(F.when(F.col("tipo") == t, row)).alias(t) for t in ("Apertura", "Clausura")])
        tables = F.struct(*[F.when(F.col(t).isNotNull(), F.array(t)).alias(t) for t in ("Apertura", "Clausura")])
        return rows.select(F.lit("sitio").alias("fuente"), F.col("season").cast("string").alias("temporada"),
                           F.to_json(tables).alias("data"))

    @cached_property
    def raw_values(self) -> DataFrame:
        base = self.table("lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("season")).agg(
            F.count_distinct("l_partkey").alias("n"), F.sum(F.floor("l_extendedprice")).alias("t"))
        n, t = F.col("n"), F.col("t")
        millions = F.floor(t / 1000000)
        hundredths = F.floor(t / 10000) % 100
        return base.select(
            txt("Club Supplier ", padded(F.col("l_suppkey"))).alias("club"), F.col("season").cast("string").alias("temporada"),
            n.cast("string").alias("jugadores_en_plantilla"), txt(F.lit(20) + n % 10, ",", n % 7).alias("edad_promedio"),
            (n % 12).cast("string").alias("extranjeros"), txt(100 + n % 800, " mil €").alias("valor_medio"),
            txt(millions, ",", two(hundredths), " mill. €").alias("valor_total"), F.lit("mercado").alias("fuente"))

    @cached_property
    def raw_stadiums(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            txt("Club Supplier ", padded(key)).alias("club"),
            F.when(F.col("s_acctbal") > 9000, "No disponible").otherwise(txt("Estadio ", key)).alias("estadio"),
            F.when(F.col("s_nationkey") == 0, "0").otherwise(F.floor("s_acctbal").cast("string")).alias("capacidad"),
            F.when(F.col("s_nationkey") > 3, F.floor("s_acctbal").cast("string")).alias("aforo"), F.lit("mercado").alias("fuente"))

    @cached_property
    def raw_teams(self) -> DataFrame:
        """Names of both match roles, as the list of teams."""
        from matchloom.operators.sets import entities_from_roles
        named = entities_from_roles(self.raw_matches.select(F.lower("local").alias("a"), F.lower("visitante").alias("b")), ["a", "b"], "equipo")
        return named.select("equipo", txt("https://t/", F.col("equipo")).alias("url"), F.lit("sitio").alias("fuente"))

    @cached_property
    def squad_base(self) -> DataFrame:
        rows = self.lines("l_partkey").groupBy("l_partkey", "l_suppkey", F.year("l_shipdate").alias("season")).agg(
            F.min("l_shipdate").alias("signed"), F.max(F.col("l_quantity").cast("int")).alias("number"))
        return rows.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))

    @cached_property
    def raw_squads(self) -> DataFrame:
        size, year = F.col("p_size"), F.col("season")
        place = F.get(F.array(*[F.lit(p) for p in POSITIONS]), size % 13)
        blank_height = (year % 2 == 1) & (size % 7 == 0)
        return self.squad_base.select(
            txt("Club Supplier ", padded(F.col("l_suppkey"))).alias("club"), year.cast("string").alias("temporada"),
            txt(F.col("p_name"), " ", F.col("p_partkey")).alias("jugador"),
            F.when(size != 50, (F.col("p_partkey") + 1).cast("string")).alias("id_tm"), F.col("number").cast("string").alias("numero"),
            place.alias("posicion"), F.date_format("signed", "dd/MM/yyyy").alias("fecha_fichaje"),
            txt(two(size % 28 + 1), "/", two(size % 12 + 1), "/", size % 30 + 1970, " (34)").alias("fecha_nacimiento"),
            txt(F.col("p_brand"), ", ", F.col("p_type")).alias("nacionalidad"),
            F.when(blank_height, "0,0").otherwise(txt("1,", size % 40 + 60, " m")).alias("altura"),
            F.when(year % 2 == 0, "").when(size % 4 == 0, "left").otherwise("right").alias("pie"),
            txt(F.floor("p_retailprice"), " mil €").alias("valor_mercado"),
            txt("https://img/", F.col("p_partkey"), ".jpg?lm=1").alias("foto_url"), F.lit("mercado").alias("fuente"))

    @cached_property
    def raw_player_stats(self) -> DataFrame:
        rows = self.lines("l_partkey", "l_suppkey").groupBy("l_partkey", "l_suppkey", F.year("l_shipdate").alias("season"), "l_returnflag").agg(
            F.sum(F.col("l_quantity").cast("int")).alias("q"))
        q = F.col("q")
        numbers = {
            "partidos_jugados": q, "titularidades": q % 23, "goles": q % 13, "asistencias": q % 7, "tarjetas_amarillas": q % 5,
            "tarjeta_amarilla_roja": q % 2, "tarjetas_rojas": q % 3, "entrada_suplente": q % 6, "salida_suplente": q % 4,
            "penaltis_anotados": q % 2, "goles_en_contra": q % 9, "partidos_imbatido": q % 5, "min_por_gol": q, "minutos_jugados": q * 40,
        }
        joined = rows.join(self.table("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
        return joined.select(
            (F.col("l_partkey") + 1).cast("string").alias("id_tm"), txt(F.col("p_name"), " ", F.col("p_partkey")).alias("jugador"),
            txt("Club Supplier ", padded(F.col("l_suppkey"))).alias("club"), F.col("season").cast("string").alias("temporada"),
            txt("Liga ", F.col("l_returnflag")).alias("competencia"), txt(q % 4, ".25").alias("ppp"),
            *[v.cast("string").alias(k) for k, v in numbers.items()],
            F.when(q % 11 == 0, "no").otherwise("true").alias("datos_disponibles"))

    @cached_property
    def raw_coaches(self) -> DataFrame:
        spells = self.match_base.groupBy("o_custkey", "lo", "o_orderdate").agg(
            F.max("q").alias("q"), F.max("gl").alias("gl"), F.max(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).alias("open"))
        q, cust = F.col("q"), F.col("o_custkey")
        return spells.select(
            txt("Club Supplier ", padded(F.col("lo"))).alias("club"), txt("Customer#", padded(cust)).alias("entrenador"),
            txt(two(cust % 28 + 1), "/", two(cust % 12 + 1), "/", cust % 30 + 1950).alias("fecha_nacimiento"),
            txt("País ", cust % 25, ", País ", cust % 7).alias("nacionalidad"),
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("comienzo"),
            F.when(F.col("open") == 1, "").otherwise(F.date_format(F.date_add("o_orderdate", (q % 300).cast("int")), "dd/MM/yyyy")).alias("salida"),
            txt(q, " días").alias("tiempo_en_cargo"), (q % 30).cast("string").alias("partidos"),
            txt(q % 3, ",", two(q % 100)).alias("ppp"), F.lit("mercado").alias("fuente"),
            F.year("o_orderdate").cast("string").alias("temporada"))

    @cached_property
    def raw_champions(self) -> DataFrame:
        totals = self.table_base.groupBy("season", "l_suppkey").agg(F.sum(F.col("pg") * 3 + F.col("pe")).alias("pts"))
        best = totals.groupBy("season").agg(
            F.min_by("l_suppkey", F.struct(-F.col("pts"), "l_suppkey")).alias("a"),
            F.min_by("l_suppkey", F.struct("pts", "l_suppkey")).alias("b"))

        def called(key: Column) -> Column:
            return (F.when(F.col("season") % 3 == 0, txt("fc súpplier#", padded(key)))
                    .when(F.col("season") % 3 == 1, txt("Supplier#", padded(key))).otherwise(txt(" s", key)))

        return best.select(F.col("season").cast("string").alias("temporada"), called(F.col("a")).alias("campeon"),
                           called(F.col("b")).alias("subcampeon"), F.lit("sitio").alias("fuente"))

    # ---- silver ---------------------------------------------------------------------
    @cached_property
    def catalog(self) -> DataFrame:
        return silver.team_catalog(self.raw_catalog, self.as_of)[0]

    @cached_property
    def teams_split(self):
        return silver.teams(self.raw_teams, self.tb_catalog, self.as_of)

    @cached_property
    def stadiums_split(self):
        return silver.stadiums(self.raw_stadiums, self.tb_catalog, self.as_of)

    @cached_property
    def players(self) -> DataFrame:
        return silver.players(self.raw_squads, None, self.as_of)[0]

    @cached_property
    def squad_tasks(self) -> int:
        """A line item makes at most one squad row."""
        return tasks_of(self.table("lineitem").count(), SQUAD_ROWS_A_TASK)

    @cached_property
    def squads_split(self):
        return silver.squads(self.raw_squads, self.tb_catalog, self.tb_players, None, self.as_of, self.squad_tasks)

    @cached_property
    def coaches(self) -> DataFrame:
        return silver.coaches(self.raw_coaches, None, self.as_of)[0]

    @cached_property
    def spells_split(self):
        return silver.coach_spells(self.raw_coaches, self.tb_catalog, self.tb_coaches, self.as_of)

    @cached_property
    def values_split(self):
        return silver.team_values(self.raw_values, self.tb_catalog, self.as_of)

    @cached_property
    def matches_split(self):
        return silver.matches(self.raw_matches, self.tb_catalog, self.as_of)

    @cached_property
    def match_stats(self) -> DataFrame:
        return silver.match_stats(self.raw_match_stats, self.tb_matches, self.as_of)[0]

    @cached_property
    def standings_split(self):
        return silver.standings(self.raw_standings, self.tb_catalog, "data", self.as_of)

    @cached_property
    def champions(self) -> DataFrame:
        return silver.champions(self.raw_champions, self.tb_catalog, self.as_of)[0]

    @cached_property
    def player_stats_split(self):
        return silver.player_stats(self.raw_player_stats, self.tb_catalog, self.tb_players, self.as_of)

    # ---- gold -----------------------------------------------------------------------
    @cached_property
    def dim(self) -> DataFrame:
        return gold.team_dimension(self.tb_catalog, self.tb_teams, self.tb_stadiums, self.tb_values, self.as_of)

    @cached_property
    def season_performance(self) -> DataFrame:
        return gold.season_performance(self.tb_standings, self.tb_values, self.tb_dim, self.as_of)

    @cached_property
    def accumulated(self) -> DataFrame:
        return gold.accumulated_performance(self.tb_standings, self.tb_values, self.tb_dim, self.as_of)

    @cached_property
    def match_detail(self) -> DataFrame:
        return gold.match_detail(self.tb_matches, self.tb_match_stats, self.tb_dim, self.as_of)

    @cached_property
    def squad_history(self) -> DataFrame:
        return gold.squad_history(self.tb_squads, self.tb_players, self.tb_dim, self.as_of)

    @cached_property
    def coach_history(self) -> DataFrame:
        return gold.coach_history(self.tb_spells, self.tb_coaches, self.tb_dim, self.as_of)

    @cached_property
    def value_history(self) -> DataFrame:
        return gold.value_history(self.tb_values, self.tb_dim, self.as_of)

    @cached_property
    def player_season_stats(self) -> DataFrame:
        # A line item makes at most one row of either, so rows need not be counted, and the statistics of competitions not be written.
        stats = self.tb_player_stats if self.is_written("player_stats") else self.player_stats_split[0]
        tasks = tasks_of(2 * self.table("lineitem").count(), gold.ROWS_A_TASK)
        return gold.player_season_stats(stats, self.tb_players, self.tb_squads, self.tb_dim, self.as_of, tasks)

    # ---- views ----------------------------------------------------------------------
    @cached_property
    def tables(self) -> DataFrame:
        return views.league_tables(self.tb_season_performance, self.tb_accumulated)

    @cached_property
    def team_matches(self) -> DataFrame:
        return views.team_matches(self.tb_match_detail)

    @cached_property
    def stats_view(self) -> DataFrame:
        return views.player_season_view(self.tb_player_season_stats)

    @cached_property
    def squad_view(self) -> DataFrame:
        return views.squad_history_view(self.tb_squad_history)

    @cached_property
    def simple_score(self) -> DataFrame:
        """Score rows with a plain score in place of the component: minutes scaled to 0-100 per position."""
        from matchloom.operators.ranking import minmax_by
        # The history is not written for this: its few columns that the profiles need go on as they are joined.
        feats = scoring.player_features(self.tb_player_season_stats.drop("id_estadistica_jugador"), self.squad_history)
        scored = feats.withColumn("score_ml", F.col("minutos_jugados").cast("double")).withColumn("var_explicada", F.lit(0.5))
        scaled = minmax_by(scored, "posicion_xi", "score_ml")
        level = F.when(F.col("score_100") >= 50, 2).otherwise(1)
        leveled = scaled.withColumn("nivel_num", level).withColumn("nivel", F.when(level == 2, "Bueno").otherwise("Regular"))
        return scoring.score_rows(leveled, self.as_of)

    @cached_property
    def score_view(self) -> DataFrame:
        return views.scored_eleven(self.tb_simple_score)

    @cached_property
    def score_seasons(self) -> DataFrame:
        return views.eleven_seasons(self.tb_simple_score)

    # ---- written tables --------------------------------------------------------------
    @cached_property
    def tb_catalog(self) -> DataFrame:
        return self.stored("catalog", lambda: self.catalog)

    @cached_property
    def tb_teams(self) -> DataFrame:
        return self.stored("teams", lambda: self.teams_split[0])

    @cached_property
    def tb_stadiums(self) -> DataFrame:
        return self.stored("stadiums", lambda: self.stadiums_split[0])

    @cached_property
    def tb_players(self) -> DataFrame:
        return self.stored("players", lambda: self.players)

    @cached_property
    def tb_squads(self) -> DataFrame:
        return self.stored("squads", lambda: self.squads_split[0], seasons=False)

    @cached_property
    def tb_coaches(self) -> DataFrame:
        return self.stored("coaches", lambda: self.coaches)

    @cached_property
    def tb_spells(self) -> DataFrame:
        return self.stored("spells", lambda: self.spells_split[0])

    @cached_property
    def tb_values(self) -> DataFrame:
        return self.stored("values", lambda: self.values_split[0])

    @cached_property
    def tb_matches(self) -> DataFrame:
        return self.stored("matches", lambda: self.matches_split[0])

    @cached_property
    def tb_match_stats(self) -> DataFrame:
        return self.stored("match_stats", lambda: self.match_stats)

    @cached_property
    def tb_standings(self) -> DataFrame:
        return self.stored("standings", lambda: self.standings_split[0])

    @cached_property
    def tb_player_stats(self) -> DataFrame:
        return self.stored("player_stats", lambda: self.player_stats_split[0].drop("id_estadistica_jugador"), seasons=False)

    @cached_property
    def tb_dim(self) -> DataFrame:
        return self.stored("dim", lambda: self.dim)

    @cached_property
    def tb_season_performance(self) -> DataFrame:
        return self.stored("season_performance", lambda: self.season_performance)

    @cached_property
    def tb_accumulated(self) -> DataFrame:
        return self.stored("accumulated", lambda: self.accumulated)

    @cached_property
    def tb_match_detail(self) -> DataFrame:
        return self.stored("match_detail", lambda: self.match_detail)

    @cached_property
    def tb_squad_history(self) -> DataFrame:
        return self.stored("squad_history", lambda: self.squad_history)

    @cached_property
    def tb_coach_history(self) -> DataFrame:
        return self.stored("coach_history", lambda: self.coach_history)

    @cached_property
    def tb_value_history(self) -> DataFrame:
        return self.stored("value_history", lambda: self.value_history)

    @cached_property
    def tb_player_season_stats(self) -> DataFrame:
        return gold.with_season_key(self.stored("player_season_stats", lambda: self.player_season_stats.drop("id_estadistica_jugador")))

    @cached_property
    def tb_simple_score(self) -> DataFrame:
        """Not written: the columns follow in one projection from the features and the limits of the score, which are stored."""
        key = (self.spark.sparkContext.applicationId, self.sf)
        if key not in _SCORES or _SCORES[key].sparkSession is not self.spark:
            _SCORES[key] = self.simple_score
        return _SCORES[key]

    @cached_property
    def tb_champions(self) -> DataFrame:
        return self.stored("champions", lambda: self.champions)
