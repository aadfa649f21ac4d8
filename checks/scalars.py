"""Scalar functions over text columns derived from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions import dates, fixed, jsonx, measures, text
from matchloom.operators.ranking import scale_to_max

from .registry import query, table

# Text forms built by expressions both engines read; the functions under test then parse them.
PART_TEXTS = {
    "name_t": "CASE p_size % 5 WHEN 0 THEN '  Ñandú ' || p_name || '  ' WHEN 1 THEN upper(p_name) || ' ÁÉÍÔ' WHEN 2 THEN p_name || '   x  y' WHEN 3 THEN '' END",
    "blank_t": "CASE p_size % 7 WHEN 0 THEN '' WHEN 1 THEN '-' WHEN 2 THEN 'n/a' WHEN 3 THEN 'None' WHEN 4 THEN '0,0' WHEN 5 THEN 'sin informacion' ELSE p_brand END",
    "money_t": "CASE p_size % 6 WHEN 0 THEN CAST(p_partkey AS STRING) || ' mil €' WHEN 1 THEN CAST(p_size AS STRING) || ',' || lpad(CAST(p_partkey % 100 AS STRING), 2, '0') || ' mill. €' "
               "WHEN 2 THEN '€' || CAST(p_partkey AS STRING) || 'k' WHEN 3 THEN '€' || CAST(p_size AS STRING) || '.' || lpad(CAST(p_partkey % 100 AS STRING), 2, '0') || 'm' "
               "WHEN 4 THEN CAST(p_partkey AS STRING) ELSE '0' END",
    "pct_t": "CASE p_size % 4 WHEN 0 THEN CAST(p_size AS STRING) || ' (' || CAST(p_partkey % 101 AS STRING) || ' %)' WHEN 1 THEN CAST(p_partkey % 100 AS STRING) || '%' WHEN 2 THEN CAST(p_size AS STRING) ELSE '' END",
    "score_t": "CASE p_size % 4 WHEN 0 THEN CAST(p_size AS STRING) || ' - ' || CAST(p_partkey % 9 AS STRING) WHEN 1 THEN 'Sin jugar' WHEN 2 THEN CAST(p_size AS STRING) || '-' ELSE CAST(p_size AS STRING) || '-' || CAST(p_partkey % 7 AS STRING) END",
    "height_t": "CASE p_size % 5 WHEN 0 THEN '1,' || CAST(60 + p_size AS STRING) || ' m' WHEN 1 THEN '1.' || CAST(60 + p_size % 30 AS STRING) || 'm' WHEN 2 THEN '-' WHEN 3 THEN '0,0' ELSE 'alto' END",
    "list_t": "CASE p_size % 3 WHEN 0 THEN p_brand || ', ' || p_type WHEN 1 THEN p_brand ELSE '' END",
    "days_t": "CASE p_size % 3 WHEN 0 THEN CAST(p_size AS STRING) || ' días' WHEN 1 THEN CAST(p_size AS STRING) || ' days' ELSE CAST(p_size AS STRING) END",
    "foot_t": "CASE p_size % 4 WHEN 0 THEN 'Left' WHEN 1 THEN 'Zurdo' WHEN 2 THEN 'right' END",
    "place_t": "CASE p_size % 6 WHEN 0 THEN ' Goalkeeper' WHEN 1 THEN 'Centre-Back' WHEN 2 THEN 'Left Winger' WHEN 3 THEN 'na' WHEN 4 THEN 'libero' END",
    "url_t": "CASE p_size % 4 WHEN 0 THEN 'https://x/a-b/profil/spieler/' || CAST(p_partkey AS STRING) WHEN 1 THEN 'https://x/club/verein/' || CAST(p_partkey AS STRING) || '/k' WHEN 2 THEN 'https://x/' || CAST(p_partkey AS STRING) || '.jpg?lm=1' ELSE 'https://x/' || CAST(p_partkey AS STRING) || '.PNG?lm=1' END",
    "number_t": "CASE p_size % 6 WHEN 0 THEN CAST(p_size AS STRING) || ' (34 %)' WHEN 1 THEN CAST(p_size AS STRING) || ' %' WHEN 2 THEN CAST(p_size AS STRING) WHEN 3 THEN CAST(p_size AS STRING) || '.5' WHEN 4 THEN 'abc' END",
    "bool_t": "CASE p_size % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'False' WHEN 2 THEN 'quizas' END",
    "index_t": "CASE p_size % 2 WHEN 0 THEN CAST(p_partkey AS STRING) || '  {\"a\": 1}' ELSE '{\"a\": 2}' END",
    "stat_t": "CASE p_size % 5 WHEN 0 THEN '1.' || lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') || '''' WHEN 1 THEN '-' WHEN 2 THEN '' WHEN 3 THEN CAST(p_size AS STRING) ELSE '2,15' END",
    "twice_t": "CASE p_size % 2 WHEN 0 THEN p_name || ' Football Club ' || p_name || ' Football Club ' ELSE p_name || p_name END",
}
BASE_SQL = "(SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in PART_TEXTS.items()) + " FROM part)"


def parts(spark, sf):
    return table(spark, sf, "part").selectExpr("*", *[f"{e} AS {n}" for n, e in PART_TEXTS.items()])


def scalar(name, spark_cols, sql_cols, base=None, base_sql=BASE_SQL, key="p_partkey"):
    """One query per function: the key, the inputs' result columns, over the whole table."""
    rows = base or parts

    @query(name, f"SELECT {key}, " + ", ".join(f"{e} AS {n}" for n, e in sql_cols.items()) + f" FROM {base_sql}")
    def _(spark, sf):
        return rows(spark, sf).select(key, *[c().alias(n) for n, c in spark_cols.items()])


ACC, UN = fixed.ACCENTED, fixed.UNACCENTED
NORM = "translate(lower(trim({c})), '" + ACC + "', '" + UN + "')"
NUM = "replace(regexp_extract({c}, '([0-9]+[,.]?[0-9]*)', 1), ',', '.')"


def blank(c, words):
    return f"({c} IS NULL OR lower(trim({c})) IN ({', '.join(repr(w) for w in words)}))"


scalar("E01_norm_name", {"v": lambda: text.norm_name("name_t")}, {"v": NORM.format(c="name_t")})
scalar("E02_placeholder_to_null", {"a": lambda: text.null_if_placeholder("blank_t"), "b": lambda: text.null_if_placeholder("blank_t", fixed.WINDOW_BLANKS)},
       {"a": f"CASE WHEN NOT {blank('blank_t', ['', '-', 'n/a', 'none'])} THEN blank_t END",
        "b": f"CASE WHEN NOT {blank('blank_t', ['', 'null', 'na', 'none', '0', '0.0', '0,0'])} THEN blank_t END"})
scalar("E03_placeholder_to_default", {"v": lambda: text.default_if_placeholder("blank_t", fixed.NUMBER_BLANKS, "0")},
       {"v": f"CASE WHEN {blank('blank_t', ['', 'null', 'na', 'none', 'sin informacion', '0', '0.0', '0,0'])} THEN '0' ELSE blank_t END"})
scalar("E04_spaces_and_percent", {"a": lambda: text.collapse_spaces("name_t"), "b": lambda: text.strip_percent("pct_t")},
       {"a": "regexp_replace(name_t, '\\s+', ' ', 'g')", "b": "replace(pct_t, '%', '')"})
scalar("E05_first_int", {"v": lambda: text.first_int("pct_t")},
       {"v": "CASE WHEN regexp_extract(pct_t, '^(\\d+)', 1) = '' OR pct_t IS NULL THEN '0' ELSE regexp_extract(pct_t, '^(\\d+)', 1) END"})
scalar("E06_percentage", {"v": lambda: text.pct("pct_t")},
       {"v": "CASE WHEN (contains(pct_t, '%') OR contains(pct_t, '(')) THEN CAST(regexp_extract(pct_t, '(\\d+)\\D*$', 1) AS DOUBLE) / 100.0 ELSE 0.0 END"})
SIDE = "TRY_CAST(nullif(regexp_extract(score_t, '^(\\d+)\\s*-\\s*(\\d+)$', {i}), '') AS INT)"
scalar("E07_score_sides", {"h": lambda: text.score_side("score_t", 1), "a0": lambda: text.score_side("score_t", 2, 0)},
       {"h": SIDE.format(i=1), "a0": f"coalesce({SIDE.format(i=2)}, 0)"})
scalar("E08_valid_score", {"v": lambda: text.valid_score("score_t")},
       {"v": "CASE WHEN regexp_matches(score_t, '^[0-9]+\\s*-\\s*[0-9]+$') THEN score_t ELSE 'sin informacion' END"})
scalar("E09_money", {"v": lambda: text.money("money_t").cast("double")},
       {"v": f"""CASE WHEN money_t = '0' THEN 0.0 WHEN money_t LIKE '%mill%' THEN round(CAST({NUM.format(c='money_t')} AS DOUBLE) * 1000000)
          WHEN money_t LIKE '%mil%' THEN CAST({NUM.format(c='money_t')} AS DOUBLE) * 1000 WHEN money_t LIKE '%k' THEN CAST({NUM.format(c='money_t')} AS DOUBLE) * 1000
          WHEN money_t LIKE '%m' THEN round(CAST({NUM.format(c='money_t')} AS DOUBLE) * 1000000) ELSE CAST({NUM.format(c='money_t')} AS DOUBLE) END"""})
scalar("E10_money_text", {"a": lambda: text.money_text("money_t"), "b": lambda: text.money_text("name_t")},
       {"a": f"""CASE WHEN p_size % 6 IN (0, 2) THEN CAST(p_partkey * 1000 AS VARCHAR) WHEN p_size % 6 IN (1, 3)
          THEN CAST(CAST(p_size AS BIGINT) * 1000000 + (p_partkey % 100) * 10000 AS VARCHAR) ELSE money_t END""", "b": "name_t"})
H = "replace(replace(replace(height_t, ' ', ''), 'm', ''), ',', '.')"
OKH = "regexp_matches(replace(height_t, ' ', ''), '^[0-9,.]+m?$') AND height_t NOT IN ('0', '0.0', '0,0')"
scalar("E11_height", {"a": lambda: text.height("height_t"), "b": lambda: text.height("height_t", None)},
       {"a": f"CASE WHEN {OKH} THEN CAST({H} AS DOUBLE) ELSE 0.0 END", "b": f"CASE WHEN {OKH} THEN CAST({H} AS DOUBLE) END"})
scalar("E12_decimal_comma", {"v": lambda: text.decimal_comma("stat_t")}, {"v": "replace(stat_t, ',', '.')"})
scalar("E13_strip_unit", {"v": lambda: text.strip_unit("days_t")}, {"v": "CAST(p_size AS VARCHAR)"})
scalar("E14_list_items", {"a": lambda: text.nth_item("list_t", 1), "b": lambda: text.nth_item("list_t", 2)},
       {"a": "trim(split_part(list_t, ',', 1))", "b": "CASE WHEN p_size % 3 = 0 THEN p_type END"})
scalar("E15_code_labels", {"place": lambda: text.position_name("place_t"), "xi": lambda: text.xi_code(text.position_name("place_t")),
                           "nombre": lambda: text.map_label(text.xi_code(text.position_name("place_t")), fixed.XI_NAMES, F.lit("OTRO"))},
       {"place": "CASE p_size % 6 WHEN 0 THEN 'Portero' WHEN 1 THEN 'Defensa Central' WHEN 2 THEN 'Extremo Izquierdo' WHEN 4 THEN 'libero' ELSE 'sin informacion' END",
        "xi": "CASE p_size % 6 WHEN 0 THEN 'POR' WHEN 1 THEN 'DFC' WHEN 2 THEN 'EI' ELSE 'OTRO' END",
        "nombre": "CASE p_size % 6 WHEN 0 THEN 'Portero' WHEN 1 THEN 'Defensa Central' WHEN 2 THEN 'Extremo Izquierdo' ELSE 'OTRO' END"})
scalar("E16_title_case", {"v": lambda: text.title("p_name")},
       {"v": "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"})
scalar("E17_active_flag", {"v": lambda: text.is_active("blank_t")},
       {"v": f"CASE WHEN {blank('blank_t', ['', 'null', 'na', 'none', 'sin informacion', '-'])} THEN 1 ELSE 0 END"})
scalar("E18_left_foot", {"v": lambda: text.left_foot("foot_t")}, {"v": "CASE WHEN p_size % 4 IN (0, 1) THEN 1 ELSE 0 END"})
scalar("E19_leading_index", {"v": lambda: text.strip_leading_index("index_t")}, {"v": "regexp_replace(index_t, '^\\d+\\s+', '')"})
scalar("E20_surrogate_keys", {"v": lambda: text.surrogate_key("p_partkey", "name_t", "p_size"), "m": lambda: F.md5(F.concat_ws("_", F.col("p_partkey").cast("string"), "p_brand"))},
       {"v": "sha256(concat_ws('-', CAST(p_partkey AS VARCHAR), name_t, CAST(p_size AS VARCHAR)))", "m": "md5(concat_ws('_', CAST(p_partkey AS VARCHAR), p_brand))"})
scalar("E21_toggle_extension", {"v": lambda: text.toggle_ext("url_t")},
       {"v": "replace(replace(replace(url_t, '.PNG?', '.#?'), '.jpg?', '.JPG?'), '.#?', '.png?')"})
scalar("E22_row_json", {"v": lambda: text.row_json(["p_partkey", "p_name", "p_size"])},
       {"v": "'{\"p_partkey\":' || p_partkey || ',\"p_name\":\"' || p_name || '\",\"p_size\":' || p_size || '}'"})
scalar("E23_number_text", {"v": lambda: text.number_text("number_t")},
       {"v": "CASE p_size % 6 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN CAST(p_size AS DOUBLE) WHEN 2 THEN CAST(p_size AS DOUBLE) WHEN 3 THEN p_size + 0.5::DOUBLE END"})
scalar("E24_ascii_fold", {"v": lambda: text.ascii_fold("name_t")}, {"v": "nullif(regexp_replace(" + NORM.format(c="name_t") + ", '\\s+', ' ', 'g'), '')"})
scalar("E25_text_to_boolean", {"v": lambda: text.bool_or_false("bool_t")}, {"v": "CASE WHEN bool_t = 'true' THEN 1 ELSE 0 END"})
scalar("E26_ids_from_urls", {"club": lambda: text.club_id_from_url("url_t"), "player": lambda: text.player_id_from_url("url_t"), "slug": lambda: text.player_slug_from_url("url_t")},
       {"club": "nullif(regexp_extract(url_t, '/verein/(\\d+)', 1), '')", "player": "nullif(regexp_extract(url_t, '/([^/]+)/profil/spieler/(\\d+)', 2), '')",
        "slug": "nullif(regexp_extract(url_t, '/([^/]+)/profil/spieler/(\\d+)', 1), '')"})
scalar("Y08_stat_text", {"a": lambda: text.stat_int("stat_t"), "b": lambda: text.stat_decimal("stat_t")},
       {"a": "coalesce(TRY_CAST(nullif(translate(stat_t, '''.,', ''), '') AS INT), 0)", "b": "coalesce(TRY_CAST(nullif(replace(replace(stat_t, '''', ''), ',', '.'), '') AS DOUBLE), 0.0)"})
scalar("Y10_repeated_half", {"v": lambda: text.halve_repeated("twice_t")},
       {"v": "CASE WHEN length(twice_t) > 30 AND left(twice_t, CAST(length(twice_t) // 2 AS INT)) = substr(twice_t, CAST(length(twice_t) // 2 + 1 AS INT)) THEN left(twice_t, CAST(length(twice_t) // 2 AS INT)) ELSE twice_t END"})

# ---- dates over orders ---------------------------------------------------------------
NAMES_ES = "[" + ", ".join(f"'{m}'" for m in fixed.SPANISH_MONTHS) + "]"


def orders(spark, sf):
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    spanish = F.get(F.array(*[F.lit(m) for m in fixed.SPANISH_MONTHS]), F.month(d) - 1)
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", F.to_date(d).alias("day"),
        F.concat(F.date_format(d, "dd/MM/yyyy"), F.lit(" ("), (k % 40).cast("string"), F.lit(")")).alias("birth_t"),
        F.when(k % 4 == 0, F.date_format(d, "dd-MM-yyyy")).when(k % 4 == 1, F.date_format(d, "EEEE, MMMM d"))
        .when(k % 4 == 2, F.date_format(d, "EEEE, MMMM d yyyy")).otherwise("99/99/2020").alias("match_t"),
        F.when(k % 5 == 0, F.concat(F.dayofmonth(d).cast("string"), F.lit(" de "), spanish, F.lit(" de "), F.year(d).cast("string")))
        .when(k % 5 == 1, F.concat(F.lit("viernes, "), F.dayofmonth(d).cast("string"), F.lit(" de "), spanish))
        .when(k % 5 == 2, F.date_format(d, "yyyy-MM-dd")).when(k % 5 == 3, "mañana").otherwise("N/A").alias("spanish_t"),
        F.when(k % 3 == 0, F.date_format(d, "d/M/yyyy")).when(k % 3 == 1, F.concat(spanish, F.lit(" "), F.year(d).cast("string"))).otherwise("otro").alias("loose_t"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, F.date_format(d, "dd/MM/yyyy")).otherwise("31/02/2020").alias("contract_t"))


ORDERS_SQL = "(SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)"


def dated(name, spark_cols, sql_cols):
    scalar(name, spark_cols, sql_cols, orders, ORDERS_SQL, "o_orderkey")


AS_OF = lambda: F.lit("2024-06-30").cast("date")
dated("D01_birth_field", {"d": lambda: dates.birth_date("birth_t"), "a": lambda: dates.birth_age("birth_t")},
      {"d": "CAST(day AS VARCHAR)", "a": "CAST(o_orderkey % 40 AS INT)"})
dated("D02_age", {"v": lambda: dates.age("day", AS_OF())}, {"v": "CAST(date_sub('year', day, DATE '2024-06-30') AS INT)"})
dated("D03_match_date", {"v": lambda: dates.match_date("match_t", F.year("day"))}, {"v": "CASE WHEN o_orderkey % 4 <> 3 THEN CAST(day AS VARCHAR) END"})
dated("D04_spanish_date", {"v": lambda: dates.spanish_date("spanish_t", F.year("day"), AS_OF())},
      {"v": "CASE WHEN o_orderkey % 5 < 3 THEN strftime(day, '%d-%m-%Y') WHEN o_orderkey % 5 = 3 THEN '01-07-2024' ELSE 'N/A' END"})
dated("D05_catalogue_date", {"a": lambda: dates.iso_date("loose_t"), "b": lambda: dates.loose_date("loose_t", F.lit(2020))},
      {"a": f"CASE o_orderkey % 3 WHEN 0 THEN strftime(day, '%Y-%-m-%-d') WHEN 1 THEN {NAMES_ES}[month(day)] || ' ' || year(day) ELSE 'otro' END",
       "b": "CASE o_orderkey % 3 WHEN 0 THEN CAST(day AS VARCHAR) WHEN 1 THEN strftime(day, '%Y-%m-01') ELSE 'otro' END"})
dated("D06_contract_date", {"v": lambda: dates.date_or_null("contract_t")}, {"v": "CASE WHEN o_orderkey % 3 = 1 THEN CAST(day AS VARCHAR) END"})
dated("D07_season_of_date", {"v": lambda: dates.season_of(dates.date_or_null("contract_t"))}, {"v": "CASE WHEN o_orderkey % 3 = 1 THEN CAST(year(day) AS INT) END"})
dated("D08_stamp_and_past_age", {"s": lambda: dates.day_stamp("o_orderdate"), "h": lambda: dates.historical_age(F.lit(30), AS_OF(), F.year("day"))},
      {"s": "CAST(strftime(day, '%Y%m%d') AS INT)", "h": "CAST(30 - (2024 - year(day)) AS INT)"})

# ---- measures over lineitem ----------------------------------------------------------
LINE_COLS = {"g": "CAST(l_quantity AS INT) % 7", "c": "CAST(l_quantity AS INT) % 5", "m": "CAST(l_quantity AS INT) * 10 - 10",
             "s": "CASE WHEN l_returnflag = 'R' THEN 'sin informacion' ELSE 'x' END"}


def lines(spark, sf):
    return table(spark, sf, "lineitem").selectExpr("*", *[f"{e} AS {n}" for n, e in LINE_COLS.items()])


LINES_SQL = "(SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in LINE_COLS.items()) + " FROM lineitem)"


def measured(name, spark_cols, sql_cols):
    scalar(name, spark_cols, sql_cols, lines, LINES_SQL, "l_orderkey")


measured("M01_per_90", {"a": lambda: F.round(measures.per90("g", "m"), 6), "b": lambda: F.round(measures.per90("g", "m", -1), 6)},
         {"a": "CASE WHEN m > 0 THEN round(g / m * 90, 6) ELSE 0.0 END", "b": "CASE WHEN m > 0 THEN round(-(g / m * 90), 6) ELSE -0.0 END"})
measured("M02_minutes_per_goal", {"v": lambda: measures.minutes_per_goal("m", "g")}, {"v": "CASE WHEN g > 0 THEN CAST(m // g AS INT) ELSE 0 END"})
measured("M03_points_and_games", {"d": lambda: measures.goal_diff("g", "c"), "p": lambda: measures.points_or_computed("m", "g", "c"), "n": lambda: measures.games_or_computed("m", "g", "c", "g")},
         {"d": "g - c", "p": "CASE WHEN m = 0 THEN g * 3 + c ELSE m END", "n": "CASE WHEN m = 0 THEN g + c + g ELSE m END"})
measured("M04_guarded_ratio", {"v": lambda: measures.ratio4("c", "g")}, {"v": "CASE WHEN g > 0 THEN round(c / g, 4) END"})
measured("M06_result_code", {"r": lambda: measures.result_code("g", "c", "s"), "e": lambda: measures.match_status("s"), "f": lambda: measures.score_missing("s")},
         {"r": "CASE WHEN s = 'sin informacion' THEN 'S/A' WHEN g > c THEN 'G' WHEN g = c THEN 'E' ELSE 'P' END",
          "e": "CASE WHEN s = 'sin informacion' THEN 'Sin jugar/Aplazado' ELSE 'Disputado' END", "f": "CASE WHEN s = 'sin informacion' THEN 1 ELSE 0 END"})
measured("M08_season_shift_and_millions", {"y": lambda: measures.shift_season(F.year("l_shipdate"), -1), "v": lambda: measures.to_millions(F.floor("l_extendedprice"))},
         {"y": "CAST(year(l_shipdate) - 1 AS INT)", "v": "round(floor(l_extendedprice) / 1000000, 2)"})

_PACE = "CASE WHEN m > 0 AND m <= 90 THEN {0} WHEN m > 90 AND m <= 130 THEN {1} WHEN m > 130 AND m <= 180 THEN {2} ELSE 0 END"
_CODES = ["DC", "MC", "DFC", "POR"]


@query("M05_eleven_score", f"""SELECT l_orderkey, l_linenumber, l_partkey, code, round(CASE code
    WHEN 'DC' THEN m / 100 + g * 8 + c * 3 + m * 0.5 + g * 1.5 - c - c * 3 - c * 5 - c * 0.5 - c * 0.3 + g * 2 + {_PACE.format(10, 6, 3)}
    WHEN 'MC' THEN m / 100 + g * 3 + c * 4 + m * 0.3 + g * 1.5 - c * 1.5 - c * 3 - c * 5 - c * 0.5 - c * 0.3 + g * 1.5 + {_PACE.format(3, 2, 1)}
    WHEN 'DFC' THEN m / 80 + m * 0.3 + g * 1.5 - c * 2 - c * 3 - c * 5 - c * 0.5 - c * 0.3 + g
    ELSE m / 70 + m * 0.3 + g * 1.5 - c * 2 - c * 3 - c * 5 + g * 1.5 + c * 2 - c * 0.5 END, 4)::DOUBLE AS score
    FROM (SELECT *, {_CODES}[CAST(l_suppkey % 4 AS INT) + 1] AS code FROM {LINES_SQL})""")
def _(spark, sf):
    code = F.get(F.array(*[F.lit(c) for c in _CODES]), F.col("l_suppkey") % 4)
    stats = {"goles": "g", "asistencias": "c", "minutos_jugados": "m", "partidos_jugados": "m", "titularidades": "g", "tarjetas_amarillas": "c",
             "segunda_amarilla": "c", "tarjetas_rojas": "c", "salida_suplente": "c", "entrada_suplente": "c", "ppp": "g", "min_por_gol": "m",
             "partidos_imbatido": "c", "goles_en_contra": "c"}
    rows = lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", code.alias("code"), *[F.col(v).alias(k) for k, v in stats.items()])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "code", F.round(measures.xi_score("code"), 4).alias("score"))


@query("M07_scale_to_max", """SELECT l_partkey, l_suppkey, q, round(q / greatest(max(abs(q)) OVER (PARTITION BY l_partkey), 0.01) * 100, 4) AS escala,
    round(q / 300.0, 4)::DOUBLE AS tope FROM (SELECT l_partkey, l_suppkey, CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2)""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum(F.col("l_quantity").cast("int")).alias("q"))
    return scale_to_max(rows, "q", ["l_partkey"]).withColumn("tope", F.round(measures.scale_to_cap("q", 300.0), 4))


# ---- JSON over events ----------------------------------------------------------------
@query("N01_parse_map_list", "SELECT event_id, CAST(props->>'$.k' AS VARCHAR) AS k, 1 AS n FROM events")
def _(spark, sf):
    rows = table(spark, sf, "events").withColumn("p", jsonx.parse_map_list("props"))
    return rows.select("event_id", F.get("p", F.lit(0)).getItem("k").alias("k"), F.size("p").alias("n"))


@query("N02_explode_items", "SELECT event_id, props->>'$.k' AS k FROM events UNION ALL SELECT event_id, event_type AS k FROM events")
def _(spark, sf):
    doubled = F.concat(F.lit("["), "props", F.lit(',{"k":"'), "event_type", F.lit('"}]'))
    rows = table(spark, sf, "events").select("event_id", jsonx.parse_map_list(doubled).alias("p"))
    return jsonx.explode_items(rows, "p").select("event_id", F.col("item").getItem("k").alias("k"))


@query("N03_dynamic_keys", """SELECT event_id, props->>'$.k' AS k, CASE WHEN event_type = 'view' THEN event_type END AS tipo, CAST(user_id AS VARCHAR) AS sub_u,
    CASE WHEN event_type = 'click' THEN 'c' END AS sub_w FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events")
    extra = F.when(F.col("event_type") == "view", F.lit(',"Tipo":"view"')).otherwise("")
    child = F.concat(F.lit(',"Sub":[{"U":'), F.col("user_id").cast("string"),
                     F.when(F.col("event_type") == "click", F.lit(',"w":"c"')).otherwise(""), F.lit("}]"))
    data = F.concat(F.lit('{"k":'), F.get_json_object("props", "$.k"), extra, child, F.lit("}"))
    return jsonx.expand_dynamic(e.select("event_id", data.alias("data")), "data")


@query("N04_explode_tables", """SELECT o_orderkey, 'Apertura' AS tipo_tabla, '1' AS posicion, o_orderstatus AS equipo FROM orders
    UNION ALL SELECT o_orderkey, 'Apertura', '2', o_orderpriority FROM orders UNION ALL SELECT o_orderkey, 'Clausura', '1', NULL FROM orders""")
def _(spark, sf):
    data = F.concat(F.lit('{"Apertura":[{"posicion":1,"equipo":"'), "o_orderstatus", F.lit('"},{"posicion":2,"equipo":"'), "o_orderpriority",
                    F.lit('"}],"Clausura":[{"posicion":1}]}'))
    rows = table(spark, sf, "orders").select("o_orderkey", data.alias("data"))
    return jsonx.explode_tables(rows, "data", ["posicion", "equipo"])
