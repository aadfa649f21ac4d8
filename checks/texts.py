"""Questions, mentions, HTML and cell parsing, and the player score, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions import fixed, words
from matchloom.operators import parsing, ranking, resolve
from matchloom.plans import questions as plans_questions
from matchloom.plans import routing, scoring

from .registry import league_query, query, table

YEAR = "CAST(2015 + o_orderkey % 10 AS STRING)"
A, B = "lpad(CAST(o_custkey % 97 AS STRING), 9, '0')", "lpad(CAST(o_orderkey % 89 AS STRING), 9, '0')"
QUESTION = f"""CASE o_orderkey % 14 WHEN 0 THEN 'Dame la tabla de posiciones clausura ' || {YEAR} WHEN 1 THEN 'compara Supplier#' || {A} || ' vs Supplier#' || {B} || ' en ' || {YEAR}
    WHEN 2 THEN '¿Quién ganó el partido entre Supplier#' || {A} || ' y Supplier#' || {B} || '?' WHEN 3 THEN 'goleadores desde ' || {YEAR} || ' hasta hoy' WHEN 4 THEN 'Mejor XI con 4-3-3 ofensivo'
    WHEN 5 THEN 'valor de mercado desde ' || {YEAR} || ' al 2030' WHEN 6 THEN 'gemas ocultas del año actual' WHEN 7 THEN 'titulares con bajo rendimiento, defensa' WHEN 8 THEN 'entrenador de Supplier#' || {A} || ' con mejor ppp'
    WHEN 9 THEN 'evolucion del score ml de Juan Fase 1' WHEN 10 THEN 'Qué equipo tiene más goles' WHEN 11 THEN 'plantel de Supplier#' || {A} WHEN 12 THEN 'precision de tiro 4 2 3 1 equilibrado portero' ELSE 'hola ' || o_orderpriority END"""


def questions(s, sf):
    """Questions written from the orders, and every document and conversation turn."""
    asked = table(s, sf, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), F.expr(QUESTION).alias("texto"))
    docs = table(s, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("texto"))
    turns = table(s, sf, "conversations").select(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"), F.col("text").alias("texto"))
    return asked.unionByName(docs).unionByName(turns)


QUESTIONS_SQL = f"""(SELECT 'o' || o_orderkey AS id, {QUESTION} AS texto FROM orders UNION ALL SELECT 'd' || doc_id, text FROM documents UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations)"""


def has(ws) -> str:
    return "(" + " OR ".join(f"contains(t, '{w}')" for w in ws) + ")"


def _list(ws) -> str:
    return "[" + ", ".join(f"'{w}'" for w in ws) + "]"


def _pair_sql(names: str) -> str:
    """CTEs up to `pairs(id, texto, t, offers, kind, a, b, known)` for the names of a statement with column n."""
    ws = "list_filter(regexp_split_to_array(trim({x}), '\\s+'), lambda w: w <> '')"
    last = "array_to_string(list_slice({x}, greatest(len({x}) - 2, 1), len({x})), ' ')"
    side = []
    for i, sep in enumerate(words.VERSUS_SEPARATORS):
        left = ws.format(x=f"split_part(trim(left(c, CAST(strpos(c, '{sep}') - 1 AS INT))), ',', 1)")
        right = ws.format(x=f"regexp_split_to_array(split_part(trim(substr(c, CAST(strpos(c, '{sep}') + {len(sep)} AS INT))), ',', 1), '\\s+(?:para|en\\s+\\d{{4}}|\\d{{4}}|del|de\\s+\\d{{4}}|\\?)')[1]")
        side.append(f"CASE WHEN strpos(c, '{sep}') > 0 THEN {left} END AS l{i}, CASE WHEN strpos(c, '{sep}') > 0 THEN {right} END AS r{i}")
    trimmed = ", ".join(f"list_slice(l{i}, coalesce(list_position(list_transform(l{i}, lambda w: NOT list_contains({_list(words.NOISE_WORDS)}, w)), true), len(l{i}) + 1), len(l{i})) AS k{i}" for i in range(3))
    ends = ", ".join(f"{last.format(x=f'k{i}')} AS a{i}, array_to_string(r{i}[1:3], ' ') AS b{i}" for i in range(3))
    sides = " ".join(f"WHEN length(a{i}) > 2 AND length(b{i}) > 2 THEN struct_pack(a := a{i}, b := b{i})" for i in range(3))
    between = "'entre\\s+(.+?)\\s+y\\s+(.+?)(?:\\s+(?:para|en|del|\\?)|$)'"
    grams = "list_distinct(list_transform(range(1, length({x})), lambda i: substr(replace({x}, ' ', '_'), i, 2)))"
    return f"""nm AS (SELECT DISTINCT n FROM ({names}) WHERE length(n) >= 4), every AS (SELECT list(n ORDER BY -length(n), n) AS ns FROM nm),
    base AS (SELECT id, texto, lower(texto) AS t, CASE WHEN {has(words.VERSUS_WORDS)} THEN lower(texto) END AS c, list_filter(ns, lambda n: contains(lower(texto), n)) AS offers FROM (SELECT id, texto, lower(texto) AS t FROM {QUESTIONS_SQL}), every),
    cut AS (SELECT *, {", ".join(side)}, {ws.format(x=f"regexp_extract(c, {between}, 1)")} AS x0, {ws.format(x=f"regexp_extract(c, {between}, 2)")} AS y0 FROM base),
    ends AS (SELECT *, {ends}, {last.format(x="x0")} AS x, array_to_string(y0[1:3], ' ') AS y FROM (SELECT *, {trimmed} FROM cut)),
    kinds AS (SELECT *, CASE WHEN c IS NULL THEN NULL WHEN len(offers) >= 2 THEN 'named' WHEN side IS NOT NULL THEN 'worded' WHEN x <> '' AND y <> '' THEN 'spoken' END AS kind FROM (SELECT *, CASE {sides} END AS side FROM ends)),
    parties AS (SELECT DISTINCT unnest([side.a, side.b]) AS p FROM kinds WHERE kind = 'worded'),
    met AS (SELECT p, n, CASE WHEN p = n THEN 0 WHEN contains(p, n) OR contains(n, p) THEN 1 WHEN sim > 0.55 THEN 2 END AS s, sim FROM
      (SELECT p, n, len(list_intersect(g, h)) / len(list_distinct(list_concat(g, h))) AS sim FROM (SELECT p, {grams.format(x="p")} AS g FROM parties), (SELECT n, {grams.format(x="n")} AS h FROM nm))),
    best AS (SELECT p, list(n ORDER BY s, CASE WHEN s = 2 THEN -sim ELSE -length(n) END, n)[1] AS n FROM met WHERE s IS NOT NULL GROUP BY 1),
    pairs AS (SELECT id, texto, t, offers, kind, CASE kind WHEN 'named' THEN offers[1] WHEN 'worded' THEN coalesce(u.n, side.a) WHEN 'spoken' THEN x END AS a, CASE kind WHEN 'named' THEN offers[2] WHEN 'worded' THEN coalesce(v.n, side.b) WHEN 'spoken' THEN y END AS b,
      CASE kind WHEN 'named' THEN true WHEN 'worded' THEN u.n IS NOT NULL OR v.n IS NOT NULL WHEN 'spoken' THEN list_contains(offers, x) OR list_contains(offers, y) END AS known
      FROM kinds LEFT JOIN best u ON kind = 'worded' AND side.a = u.p LEFT JOIN best v ON kind = 'worded' AND side.b = v.p)"""


# Teams, some of the words that stand for them, and an alias for each.
TEAMS_SQL = f"SELECT lower(s_name) AS n FROM supplier UNION ALL SELECT 'club ' || s_suppkey FROM supplier UNION ALL SELECT unnest({_list(words.EXTRA_TEAM_NAMES)})"
PAIR, TEAM_PAIR = _pair_sql("SELECT lower(s_name) AS n FROM supplier"), _pair_sql(TEAMS_SQL)


def _teams(s, sf):
    teams = table(s, sf, "supplier").select(F.col("s_name").alias("nombre_equipo"), F.concat(F.lit("Club "), F.col("s_suppkey").cast("string")).alias("alias_equipo"))
    return plans_questions.known_team_names(teams, words.EXTRA_TEAM_NAMES)


def _intent_sql() -> str:
    f = {n: has(ws) for n, ws in words.INTENT_WORDS.items()}
    f["mejor_xi"] = f"({f['mejor_xi']} OR regexp_matches(t, '\\bxi\\b'))"
    f["goles_equipo"] = f"({has(words.TEAM_GOAL_WORDS)} OR (contains(t, 'equipo') AND {has(words.TEAM_GOAL_PARTS)}))"
    f["vs"] = "(kind IS NOT NULL)"
    f["partidos"] = f"({f['partidos']} OR (contains(t, 'vs') AND NOT {f['vs']}))"
    f["equipo"] = "(coalesce(len(offers), 0) > 0)"
    spans = f"((len(ys) = 1 AND {has(words.UNTIL_NOW_WORDS)}) OR (len(ys) >= 2 AND ys[1] <> ys[-1]))"
    e = {k: f"has_{k}" for k in f}
    route = [("partido_rival", f"{e['h2h']} AND {e['vs']}"), ("goles_por_equipo", e["goles_equipo"]), ("vs_entrenadores", f"{e['vs']} AND {e['entrenadores']}"), ("vs", e["vs"]), ("campeones", e["campeones"]),
             ("entrenadores", e["entrenadores"]), ("mejor_xi", e["mejor_xi"]), ("gemas_ocultas", e["gemas_ocultas"]), ("bajo_rendimiento", e["bajo_rendimiento"]),
             ("score_ml_evolucion", f"{e['score_ml']} AND {has(words.SCORE_HISTORY_WORDS)}"), ("score_ml", e["score_ml"]),
             ("evolucion_valor_liga", f"{e['valoracion']} AND NOT {e['equipo']} AND ({e['evolucion']} OR span)"), ("valoracion_equipos", e["valoracion"]), ("plantilla_equipo", f"{e['plantilla']} AND {e['equipo']}"),
             ("perfil_jugador", f"{e['perfil']} AND NOT {e['equipo']}"), ("mayor_goleada", e["goleada"]), ("top_goleadores", e["goleadores"]), ("eficiencia_historica", e["eficiencia"]), ("carrera_titulo", e["carrera_titulo"]),
             ("evolucion_puntos", f"({e['evolucion']} OR span) AND {e['equipo']}"), ("gep_equipo", f"{e['gep']} AND {e['equipo']}"), ("precision_tiro", e["precision_tiro"]), ("partidos_equipo", f"{e['partidos']} AND {e['equipo']}"),
             ("rendimiento_equipo", e["equipo"])]
    case = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in route) + " ELSE 'tabla_posiciones' END"
    flags = ", ".join(f"{x} AS has_{n}" for n, x in f.items())
    ints = ", ".join(f"CAST(has_{n} AS INT) AS es_{n}" for n in f)
    year = f"CASE WHEN {has(words.THIS_YEAR_WORDS)} AND len(ys) = 0 THEN 2024 WHEN NOT coalesce({spans}, false) THEN TRY_CAST(ys[1] AS INT) END"
    return (f"{TEAM_PAIR}, routed AS (SELECT *, {ints}, {case} AS ruta, offers[1] AS equipo FROM (SELECT *, {flags}, {spans} AS span, CAST({year} AS INT) AS temporada FROM (SELECT *, regexp_extract_all(texto, '\\b(20\\d{{2}})\\b', 1) AS ys FROM pairs)))",
            ", ".join(f"es_{n}" for n in f))


ROUTED, FLAGS = _intent_sql()
# A player's name holds every long word of one of the parties.
HELD = "EXISTS (SELECT 1 FROM (SELECT lower(c_name) || ' ' || lower(c_mktsegment) AS n FROM customer) k WHERE {x} IS NOT NULL AND len(list_filter(CASE WHEN len({l}) > 0 THEN {l} ELSE [trim({x})] END, lambda w: NOT contains(k.n, w))) = 0)"
LONG = "list_filter(regexp_split_to_array(trim({x}), '\\s+'), lambda w: length(w) >= 3)"


@query("Y02_intents_and_route", f"WITH {ROUTED} SELECT id, {FLAGS}, ruta, a AS entidad_a, b AS entidad_b, equipo, temporada FROM routed")
def _(s, sf):
    out = routing.route_questions(questions(s, sf), "texto", _teams(s, sf), this_year=F.lit(2024))
    return out.select("id", *[c for c in out.columns if c.startswith("es_")], "ruta", "entidad_a", "entidad_b", "equipo", "temporada")


@query("Y02_targets_of_questions", f"""WITH {ROUTED}, loose AS (SELECT p, {HELD.format(x="p", l="l")} AS held FROM (SELECT p, {LONG.format(x="p")} AS l FROM (SELECT DISTINCT unnest([a, b]) AS p FROM routed WHERE ruta = 'vs' AND NOT known)))
    SELECT id, ruta, CASE WHEN ruta <> 'vs' THEN '["' || ruta || '"]' WHEN known THEN '["vs_equipos","vs_detalle_estadisticas"' || CASE WHEN temporada IS NULL THEN ']' ELSE ',"partido_rival"]' END
    WHEN u.held OR v.held THEN '["vs_jugadores"]' ELSE '["vs_entrenadores"]' END AS objetivos FROM routed LEFT JOIN loose u ON ruta = 'vs' AND a = u.p LEFT JOIN loose v ON ruta = 'vs' AND b = v.p""")
def _(s, sf):
    players = table(s, sf, "customer").select(F.concat_ws(" ", "c_name", "c_mktsegment").alias("nombre"))
    out = routing.route_questions(questions(s, sf), "texto", _teams(s, sf), players, this_year=F.lit(2024))
    return out.select("id", "ruta", "objetivos")


def _groups(groups) -> str:
    return "CASE " + " ".join(f"WHEN {has(ws)} THEN '{n}'" for n, ws in groups.items()) + " END"


@query("Y03_question_slots", f"""SELECT id, CAST(CASE WHEN {has(words.THIS_YEAR_WORDS)} AND len(ys) = 0 THEN 2024 WHEN NOT span THEN TRY_CAST(ys[1] AS INT) END AS INT) AS temporada,
    CAST(CASE WHEN span THEN least(CAST(ys[1] AS INT), CAST(ys[-1] AS INT)) END AS INT) AS desde, CAST(CASE WHEN span AND len(ys) = 1 THEN 2024 WHEN span THEN greatest(CAST(ys[1] AS INT), CAST(ys[-1] AS INT)) END AS INT) AS hasta,
    CASE WHEN contains(t, 'clausura') THEN 'Clausura' WHEN contains(t, 'apertura') THEN 'Apertura' WHEN contains(t, 'fase 1') THEN 'Fase 1' WHEN contains(t, 'fase 2') THEN 'Fase 2' ELSE 'Acumulado' END AS tipo_tabla,
    replace(nullif(regexp_extract(texto, '\\b(\\d[-\\s]\\d[-\\s]\\d(?:[-\\s]\\d)?)\\b', 1), ''), ' ', '-') AS formacion, {_groups(words.STYLE_WORDS)} AS estilo, {_groups(words.POSITION_WORDS)} AS posicion
    FROM (SELECT *, coalesce((len(ys) = 1 AND {has(words.UNTIL_NOW_WORDS)}) OR (len(ys) >= 2 AND ys[1] <> ys[-1]), false) AS span FROM
    (SELECT id, texto, lower(texto) AS t, regexp_extract_all(texto, '\\b(20\\d{{2}})\\b', 1) AS ys FROM {QUESTIONS_SQL}))""")
def _(s, sf):
    return routing.extract_question_slots(questions(s, sf), "texto", F.lit(2024)).drop("texto")


NAMES_SQL = "(SELECT lower(s_name) AS n FROM supplier UNION SELECT lower(substr(s_name, 12)) FROM supplier UNION SELECT lower(r_name) FROM region)"


def _names(s, sf):
    """Team names, the number part of each, and the region names: names within names."""
    sup = table(s, sf, "supplier").select(F.explode(F.array("s_name", F.substring("s_name", 12, 99))).alias("nombre"))
    return sup.unionByName(table(s, sf, "region").select(F.col("r_name").alias("nombre")))


@query("Y04_mentions", f"""SELECT id, '[' || coalesce(array_to_string(list_transform(f, lambda x: '"' || x || '"'), ','), '') || ']' AS menciones FROM (
    SELECT q.id, list_reduce(list(n ORDER BY -length(n), n), lambda acc, x: CASE WHEN contains(acc.r, x) THEN struct_pack(r := left(acc.r, CAST(strpos(acc.r, x) - 1 AS INT)) || ' ' || substr(acc.r, CAST(strpos(acc.r, x) + length(x) AS INT)),
      f := list_append(acc.f, x)) ELSE acc END, struct_pack(r := any_value(lower(texto)), f := CAST([] AS VARCHAR[]))).f AS f FROM {QUESTIONS_SQL} q JOIN {NAMES_SQL} k ON contains(lower(texto), n) GROUP BY q.id)
    UNION ALL SELECT id, '[]' FROM {QUESTIONS_SQL} q WHERE NOT EXISTS (SELECT 1 FROM {NAMES_SQL} k WHERE contains(lower(q.texto), n))""")
def _(s, sf):
    return resolve.extract_mentions(questions(s, sf), _names(s, sf), "texto").drop("texto")


@query("Y04_passages_in_documents", "SELECT doc_id, count(*) AS pasajes FROM documents JOIN (SELECT DISTINCT lower(trim(text)) AS p FROM benchmark) ON contains(lower(text), p) GROUP BY 1")
def _(s, sf):
    known = table(s, sf, "benchmark").select(F.lower(F.trim("text")).alias("p")).distinct()
    docs = table(s, sf, "documents").select("doc_id", F.lower("text").alias("t"))
    return resolve.contained_ids(docs, known, "doc_id", "t", "p", n=8).groupBy("doc_id").agg(F.count(F.lit(1)).alias("pasajes"))


@query("Y05_versus_pair", f"WITH {PAIR} SELECT id, a AS entidad_a, b AS entidad_b FROM pairs")
def _(s, sf):
    return routing.extract_vs_pair(questions(s, sf), table(s, sf, "supplier").select(F.col("s_name").alias("nombre")), "texto").drop("texto")


@query("Y05_versus_pair_named", f"""SELECT id, least(f[1], f[2]) AS uno, greatest(f[1], f[2]) AS otro FROM (SELECT id, regexp_extract_all(lower(texto), 'supplier#\\d+') AS f FROM {QUESTIONS_SQL})
    WHERE len(f) >= 2 AND f[1] <> f[2] AND f[1] IN (SELECT lower(s_name) FROM supplier) AND f[2] IN (SELECT lower(s_name) FROM supplier)""")
def _(s, sf):
    sup = table(s, sf, "supplier").select(F.lower("s_name").alias("nombre"))
    pairs = routing.extract_vs_pair(questions(s, sf), sup, "texto")
    exact = pairs.join(sup.withColumnRenamed("nombre", "entidad_a"), "entidad_a", "left_semi").join(sup.withColumnRenamed("nombre", "entidad_b"), "entidad_b", "left_semi")
    named = exact.filter(F.lower("texto").contains(F.col("entidad_a")) & F.lower("texto").contains(F.col("entidad_b")) & (F.col("entidad_a") != F.col("entidad_b")))
    return named.select("id", F.least("entidad_a", "entidad_b").alias("uno"), F.greatest("entidad_a", "entidad_b").alias("otro"))


_STATE = "CASE WHEN p_size % 5 = 0 THEN 404 WHEN p_size % 5 = 1 THEN 200 WHEN p_size % 5 = 2 THEN 500 WHEN p_size % 5 = 3 THEN 404 END"


@query("Y01_resolve_urls", f"""SELECT p_partkey, CASE WHEN p_size % 11 = 0 THEN '{fixed.DEFAULT_PHOTO}' WHEN p_size % 7 = 0 THEN 'https://i/default.jpg?x=' || p_partkey WHEN p_size % 5 = 0 THEN 'https://i/' || p_partkey || '.JPG?lm=1'
    WHEN p_size % 5 = 3 THEN '{fixed.DEFAULT_PHOTO}' ELSE 'https://i/' || p_partkey || '.jpg?lm=1' END AS foto_url FROM part""")
def _(s, sf):
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    url = F.concat(F.lit("https://i/"), key, F.lit(".jpg?lm=1"))
    p = table(s, sf, "part").select("p_partkey", "p_size", url.alias("u"))
    photos = p.select("p_partkey", F.when(size % 11 == 0, " ").when(size % 7 == 0, F.concat(F.lit("https://i/default.jpg?x="), key)).otherwise(F.col("u")).alias("foto_url"))
    status = p.select(F.col("u").alias("url"), F.expr(_STATE).alias("status")).filter("status IS NOT NULL").unionByName(
        p.select(F.replace("u", F.lit(".jpg?"), F.lit(".JPG?")).alias("url"), F.when(size % 5 == 0, 200).otherwise(404).alias("status")))
    return resolve.resolve_urls(photos, status)


def _cell(*xs):
    return F.concat(*[F.concat(F.lit("<td>"), x.cast("string"), F.lit("</td>")) for x in xs])


@query("Y06_html_standings", """SELECT o_orderkey, CAST(r AS INT) AS fila, CAST(r AS INT) AS posicion, 'Equipo ' || o_custkey AS equipo, 30 AS puntos, CAST(o_custkey % 20 AS INT) AS partidos_jugados, 5 AS partidos_ganados, 0 AS partidos_empatados,
    3 AS partidos_perdidos, 40 AS goles_favor, CAST(o_orderkey % 30 AS INT) AS goles_contra, CAST(40 - o_orderkey % 30 AS INT) AS diferencia_goles FROM orders, (SELECT unnest(range(1, 5)) AS r) WHERE o_orderstatus <> 'P'""")
def _(s, sf):
    head = F.when(F.col("o_orderstatus") == "P", "<tr><th>Otra</th><th>Cosa</th></tr>").otherwise("<tr><th>Pos.</th><th>Equipo</th><th>Pts.</th></tr>")
    rows = [F.concat(F.lit("<tr class='x'>"), _cell(F.lit(f"{r}.º"), F.concat(F.lit("<a>Equipo "), F.col("o_custkey").cast("string"), F.lit("</a> (C)")), F.lit("30"), F.col("o_custkey") % 20, F.lit("5"), F.lit("-"),
                                                F.lit("3"), F.lit("40"), F.col("o_orderkey") % 30), F.lit("</tr>")) for r in range(1, 5)]
    short = F.lit("<tr><td>9</td></tr>")
    html = F.concat(F.lit("<html><table id=1>"), head, *rows, short, F.lit("</table></html>"))
    out = parsing.html_table_rows(table(s, sf, "orders").select("o_orderkey", html.alias("html")), "html")
    return out.drop("tabla")


_PLAIN = "replace(replace(replace(trim(regexp_replace({x}, '\\s+', ' ', 'g')), '&quot;', '\"'), '&lt;', '<'), '&amp;', '&')"


@query("Y06_list_items_of_pages", f"""SELECT page_id, CAST(i - 1 AS INT) AS item, {_PLAIN.format(x="x[i]")} AS texto FROM
    (SELECT page_id, regexp_extract_all(html, '<li><a [^>]*>([^<]*)</a></li>', 1) AS x FROM pages), (SELECT unnest(range(1, 1000)) AS i) WHERE i <= len(x)""")
def _(s, sf):
    return parsing.html_list_items(table(s, sf, "pages").select("page_id", "html"), "html").filter("lista = 0").drop("lista")


@query("Y06_table_rows_of_pages", f"""SELECT page_id, CAST(i - 1 AS INT) AS fila, {_PLAIN.format(x="x[i]")} AS texto, CAST(length(x[i]) % 7 AS VARCHAR) AS dentro FROM
    (SELECT page_id, regexp_extract_all(html, '<li><a [^>]*>([^<]*)</a></li>', 1) AS x FROM pages), (SELECT unnest(range(1, 1000)) AS i) WHERE i <= len(x)""")
def _(s, sf):
    """The lists of the pages written as tables without end tags of rows and cells, with a table in each cell."""
    html = F.regexp_replace(F.col("html"), "<li><a [^>]*>([^<]*)</a></li>", "<tr><td>$1<table><tr><td>$1</table>")
    html = F.regexp_replace(F.regexp_replace(html, "<ul>", "<table>"), "</ul>", "</table>")
    rows = parsing.html_rows(table(s, sf, "pages").select("page_id", "html", html.alias("h")), "h")
    names = F.regexp_extract_all(F.col("html"), F.lit("<li><a [^>]*>([^<]*)</a></li>"), F.lit(1))
    outer = rows.filter("tabla = 0").select("page_id", "fila", F.get("celdas", F.lit(0)).alias("texto"), F.get(names, F.col("fila")).alias("raw"))
    inner = rows.filter("tabla > 0").select(F.col("page_id").alias("p"), (F.col("tabla") - 1).alias("f"), F.get("celdas", F.lit(0)).alias("t"))
    both = outer.join(inner, F.expr("page_id = p and fila = f and texto = t"))
    return both.select("page_id", "fila", "texto", (F.length("raw") % 7).cast("string").alias("dentro"))


@query("Y06_nested_tables", """SELECT o_orderkey, CAST(t AS INT) AS tabla, CAST(f AS INT) AS fila, CASE WHEN t = 0 AND f = 0 THEN 'a' || o_custkey || '|é & <' || o_orderstatus || '>' WHEN t = 0 THEN 'z' WHEN t = 1 AND f = 0 THEN 'in ' || o_orderkey || '|2'
    WHEN t = 1 THEN 'Ω' ELSE 'deep' END AS celdas FROM orders, (VALUES (0, 0), (0, 1), (1, 0), (1, 1), (2, 0)) AS v(t, f) WHERE NOT (t = 0 AND f = 1 AND o_orderstatus = 'O') AND NOT (t = 2 AND o_orderstatus <> 'F')""")
def _(s, sf):
    deep = F.when(F.col("o_orderstatus") == "F", "<table><tr><td>deep</table>").otherwise("")
    inner = F.concat(F.lit("<TABLE class='a>b'><tr><th>in "), F.col("o_orderkey").cast("string"), F.lit("<td>2<tr><td>&Omega;"), deep, F.lit("</TABLE>"))
    last = F.when(F.col("o_orderstatus") == "O", "").otherwise("<tr><td>z")
    html = F.concat(F.lit("<!-- <table> --><table><tr><td>a"), F.col("o_custkey").cast("string"), inner, F.lit("<td>&eacute; &amp; &lt;"), F.col("o_orderstatus"), F.lit("&#62;"), last)
    rows = parsing.html_rows(table(s, sf, "orders").select("o_orderkey", html.alias("html")), "html")
    return rows.withColumn("celdas", F.array_join("celdas", "|"))


@query("Y07_html_stat_pairs", "SELECT o_orderkey, CAST(o_custkey % 50 AS VARCHAR) AS a, '7 (64 %)' AS b, 2 AS pares FROM orders")
def _(s, sf):
    item = F.concat(F.lit('<ul><li class="css-Stat x"><div class="StatBox"><div>'), (F.col("o_custkey") % 50).cast("string"), F.lit('</div></div><span class="a-StatTitle">Tiros totales</span><div class="StatBox b"><div><b>7</b></div>\n (64&nbsp;%)</div>'),
                    F.lit('<li class="other">z</li><li class="Stat"><span class="StatTitle">Solo</span></li></ul>'))
    out = parsing.html_stat_pairs(table(s, sf, "orders").select("o_orderkey", item.alias("html")), "html")
    m = F.col("estadisticas")
    return out.select("o_orderkey", m.getItem("Tiros totales_local").alias("a"), m.getItem("Tiros totales_visitante").alias("b"), F.size(m).alias("pares"))


@query("Y09_layout_by_arity", """SELECT l_orderkey, l_linenumber, l_partkey, 'Liga' AS competencia, CAST(l_quantity AS INT) AS partidos_jugados, 4 AS titularidades, 1.5::DOUBLE AS ppp, CASE WHEN p THEN 0 ELSE 5 END AS goles,
    CASE WHEN p THEN 0 ELSE 6 END AS asistencias, 8 AS tarjetas_amarillas, 9 AS tarjeta_amarilla_roja, 10 AS tarjetas_rojas, CASE WHEN p THEN 0 ELSE 11 END AS entrada_suplente, CASE WHEN p THEN 0 ELSE 12 END AS salida_suplente,
    CASE WHEN p THEN 0 ELSE 13 END AS penaltis_anotados, CASE WHEN p THEN 12 ELSE 0 END AS goles_en_contra, CASE WHEN p THEN 13 ELSE 0 END AS partidos_imbatido, CASE WHEN p THEN 0 ELSE 1014 END AS min_por_gol,
    CASE WHEN p THEN 1014 ELSE 2215 END AS minutos_jugados FROM (SELECT *, l_returnflag = 'R' AS p FROM lineitem)""")
def _(s, sf):
    fixed_cells = ["5", "6", "-", "8", "9", "10", "11", "12", "13", "1.014'"]
    cells = F.array(F.lit(""), F.lit(" Liga "), F.col("l_quantity").cast("int").cast("string"), F.lit("4"), F.lit("1,5"), *[F.lit(c) for c in fixed_cells])
    both = F.when(F.col("l_returnflag") == "R", cells).otherwise(F.array_append(cells, F.lit("2,215")))
    return parsing.layout_by_arity(table(s, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", both.alias("c")), "c")


@query("Y11_classify_cells", """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS numero, strftime(o_orderdate, '%d/%m/%Y') || ' (30)' AS fecha_nacimiento, '1,8' || (o_orderkey % 10) || 'm' AS altura, CASE WHEN o_orderstatus = 'F' THEN 'Izquierdo' ELSE 'Derecho' END AS pie,
    '01/02/2020' AS fecha_fichaje, '300 mil €' AS valor_mercado, 'Perú, Chile' AS nacionalidad FROM orders""")
def _(s, sf):
    cells = F.array(F.col("o_custkey").cast("string"), F.lit("Nombre"), F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" (30)")),
                    F.concat(F.lit("1,8"), (F.col("o_orderkey") % 10).cast("string"), F.lit("m")), F.when(F.col("o_orderstatus") == "F", "left foot").otherwise("Derecho"), F.lit("01/02/2020"), F.lit("x"))
    rows = table(s, sf, "orders").select("o_orderkey", cells.alias("c"), F.lit(" 300 mil € ").alias("v"), F.array(F.lit("Perú"), F.lit(""), F.lit("Chile")).alias("b"))
    return parsing.classify_cells(rows, "c", "v", "b")


@query("Y11_cells_of_many_shapes", """SELECT o_orderkey, CASE WHEN k = 1 THEN 'Sin Número' ELSE CAST(o_custkey AS VARCHAR) END AS numero, CASE WHEN k = 6 THEN '' ELSE d END AS fecha_nacimiento, CASE WHEN k IN (3, 6) THEN '' ELSE '1,7' || (o_orderkey % 10) || 'm' END AS altura,
    CASE WHEN k IN (3, 6) THEN '' WHEN o_orderstatus = 'F' THEN 'Izquierdo' ELSE 'Derecho' END AS pie, CASE WHEN k IN (3, 6) THEN '' ELSE '01/02/2020' END AS fecha_fichaje
    FROM (SELECT *, o_orderkey % 7 AS k, strftime(o_orderdate, '%d/%m/%Y') || CASE WHEN o_orderkey % 7 = 5 THEN '' ELSE ' (30)' END AS d FROM orders) WHERE k <> 4""")
def _(s, sf):
    """Seven kinds of rows: the usual one, no number, cells in other places, fields missing, too short, upper case and a third date, no field at all."""
    c = F.col("o_custkey").cast("string")
    k = F.col("o_orderkey") % 7
    born = F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), F.when(k == 5, "").otherwise(" (30)"))
    tall = F.concat(F.lit("1,7"), (F.col("o_orderkey") % 10).cast("string"), F.lit("m"))
    foot = F.when(F.col("o_orderstatus") == "F", "left foot").otherwise("Derecho")
    since, name, none = F.lit("01/02/2020"), F.lit("Nombre"), F.lit("")
    shapes = [[c, name, born, tall, foot, since, F.lit("x")], [none, name, tall, foot, born, since], [c, F.lit("09/09/1999"), foot, F.lit("x"), born, F.lit("1.80"), since, tall],
              [c, name, born, F.lit("-"), none], [c, name, born, foot], [F.concat(F.lit(" "), c, F.lit(" ")), name, F.upper(foot), F.concat(tall, F.lit(" ")), born, since, F.lit("03/03/2021")], [c, name, F.lit("1,8 m"), F.lit("pie"), F.lit("2020")]]
    cells = None
    for i, shape in enumerate(shapes):
        cells = F.when(k == i, F.array(*shape)) if cells is None else cells.when(k == i, F.array(*shape))
    return parsing.classify_cells(table(s, sf, "orders").select("o_orderkey", cells.alias("c")), "c")


# ---- score -----------------------------------------------------------------------------------


def _vectors(s, sf):
    """Sums of eight neighbouring embedding elements as features, so that all elements count, and the label as group."""
    e = table(s, sf, "embeddings")
    return e.select("vec_id", F.concat(F.lit("g"), F.col("label").cast("string")).alias("grupo"), *[F.aggregate(F.slice("embedding", 8 * i + 1, 8), F.lit(0.0), lambda t, x: t + x.cast("double")).alias(f"f{i}") for i in range(8)])


_FEATS = {f"g{i}": [f"f{j}" for j in range(8)] for i in range(10)}
_SIGNS = {g: "f0" for g in _FEATS}


@query("L2_component_scores")
def _(s, sf):
    out = scoring.component_scores(_vectors(s, sf), "grupo", _FEATS, _SIGNS)
    return out.select("vec_id", "grupo", F.round("score_ml", 6).alias("score_ml"), F.round("var_explicada", 6).alias("var_explicada"))


@query("L2_score_properties", "SELECT 'g' || label AS grupo, count(*) AS n, 0.0::DOUBLE AS media, 1 AS signo, 1 AS parte FROM embeddings GROUP BY 1")
def _(s, sf):
    out = scoring.component_scores(_vectors(s, sf), "grupo", _FEATS, _SIGNS)
    return out.groupBy("grupo").agg(F.count(F.lit(1)).alias("n"), F.abs(F.round(F.avg("score_ml"), 6)).alias("media"), (F.corr("score_ml", "f0") >= 0).cast("int").alias("signo"),
                                    (F.round(F.var_pop("score_ml") / 8, 6) == F.round(F.max("var_explicada"), 6)).cast("int").alias("parte"))


@query("L3_scale_by_group", "WITH f AS (SELECT vec_id, label, list_sum((embedding::DOUBLE[])[1:8]) AS f0 FROM embeddings) SELECT vec_id, round((f0 - min(f0) OVER w) / (max(f0) OVER w - min(f0) OVER w) * 100, 6) AS score_100 FROM f WINDOW w AS (PARTITION BY label)")
def _(s, sf):
    return ranking.minmax_by(_vectors(s, sf), "grupo", "f0", digits=6).select("vec_id", "score_100")


@query("L4_levels")
def _(s, sf):
    scored = scoring.component_scores(_vectors(s, sf), "grupo", _FEATS, _SIGNS)
    return scoring.cluster_levels(scored, "grupo", _FEATS).select("vec_id", "grupo", "nivel_num", "nivel")


def _lloyd(n: int = 8, k: int = 4, rounds: int = 100) -> str:
    """The rounds of `cluster_levels` as a recursive statement over whole millionths."""
    each = range(1, n + 1)
    q, c = ", ".join(f"q{i}" for i in each), ", ".join(f"c{i}" for i in each)
    means = ", ".join(f"CAST(floor((2 * sum(q{i}) + count(*)) / (2.0 * count(*))) AS BIGINT) AS c{i}" for i in each)
    return f"""WITH RECURSIVE f AS (SELECT vec_id, 'g' || label AS g, {", ".join(f"list_sum((embedding::DOUBLE[])[{8 * i - 7}:{8 * i}]) AS x{i}" for i in each)} FROM embeddings),
    m AS (SELECT g, {", ".join(f"avg(x{i}) AS m{i}, stddev_pop(x{i}) AS d{i}" for i in each)} FROM f GROUP BY g),
    z AS (SELECT vec_id, g, CAST(round(x1 * 1000000) AS BIGINT) AS s, {", ".join(f"CAST(round((x{i} - m{i}) / d{i} * 1000000) AS BIGINT) AS q{i}" for i in each)} FROM f JOIN m USING (g)),
    p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY s, {q}) AS rk, count(*) OVER (PARTITION BY g) AS n FROM z),
    c AS (SELECT 0 AS it, g, CAST(floor((rk - 1) * {k} / n) AS INT) AS k, {means} FROM p WHERE n >= {2 * k} GROUP BY 2, 3
      UNION ALL SELECT it + 1, g, w.k, {means} FROM (SELECT it, p.vec_id, p.g, {q}, min(struct_pack(d := {" + ".join(f"(q{i} - c{i}) * (q{i} - c{i})" for i in each)}, k := c.k)) AS w FROM c JOIN p ON c.g = p.g WHERE it < {rounds} GROUP BY ALL) GROUP BY it, g, w.k),
    a AS (SELECT p.vec_id, p.g, s, min(struct_pack(d := {" + ".join(f"(q{i} - c{i}) * (q{i} - c{i})" for i in each)}, k := c.k)).k AS k FROM p JOIN c ON c.g = p.g AND it = {rounds} GROUP BY ALL),
    o AS (SELECT g, k, CAST(row_number() OVER (PARTITION BY g ORDER BY avg(s), k) - 1 AS INT) AS nivel_num FROM a GROUP BY g, k)
    SELECT p.vec_id, p.g AS grupo, nivel_num, ['Suplente', 'Regular', 'Bueno', 'Elite'][nivel_num + 1] AS nivel FROM p LEFT JOIN a USING (vec_id) LEFT JOIN o ON o.g = a.g AND o.k = a.k"""


@query("L4_levels_by_feature", _lloyd())
def _(s, sf):
    scored = scoring.component_scores(_vectors(s, sf), "grupo", _FEATS, _SIGNS)
    return scoring.cluster_levels(scored, "grupo", _FEATS, score="f0").select("vec_id", "grupo", "nivel_num", "nivel")


@query("L4_level_properties", "SELECT 'g' || label AS grupo, count(*) AS n, count(*) AS con_nivel, 4::BIGINT AS niveles, 1 AS en_orden FROM embeddings GROUP BY 1 HAVING count(*) >= 8")
def _(s, sf):
    """Every row of a large group has one of four levels, and levels follow the mean score."""
    scored = scoring.component_scores(_vectors(s, sf), "grupo", _FEATS, _SIGNS)
    rows = scoring.cluster_levels(scored, "grupo", _FEATS).groupBy("grupo", "nivel_num").agg(F.count(F.lit(1)).alias("n"), F.avg("score_ml").alias("m"))
    out = rows.groupBy("grupo").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("nivel_num").isNotNull(), F.col("n"))).alias("con_nivel"), F.count("nivel_num").alias("niveles"),
                                    (F.array_sort(F.collect_list(F.struct("nivel_num", "m")))["m"] == F.array_sort(F.collect_list("m"))).cast("int").alias("en_orden"))
    return out.where("n >= 8")


@league_query("G9_score_properties", """SELECT posicion_xi, count(*) AS n, CAST(CASE WHEN count(*) >= 2 AND posicion_xi <> 'OTRO' THEN 1 ELSE 0 END AS INT) AS con_score, CAST(CASE WHEN count(*) >= 8 AND posicion_xi <> 'OTRO' THEN count(*) ELSE 0 END AS BIGINT) AS con_nivel, 1 AS en_orden
    FROM feats WHERE posicion_xi IS NOT NULL GROUP BY 1""")
def _(L):
    """Of the whole score job: nobody is lost, groups large enough have scores from 0 to 100 and levels that follow them."""
    out = scoring.score_players(L.tb_player_season_stats, L.squad_history, L.as_of).where("posicion_xi is not null")
    rows = out.groupBy("posicion_xi", "nivel_num").agg(F.count(F.lit(1)).alias("n"), F.avg("score_ml").alias("m"), F.min("score_100").alias("lo"), F.max("score_100").alias("hi"))
    ordered = F.array_sort(F.collect_list(F.when(F.col("nivel_num").isNotNull(), F.struct("nivel_num", "m"))))["m"] == F.array_sort(F.collect_list(F.when(F.col("nivel_num").isNotNull(), F.col("m"))))
    return rows.groupBy("posicion_xi").agg(F.sum("n").alias("n"), (F.coalesce(F.min("lo"), F.lit(-1)).between(0, 50) & F.coalesce(F.max("hi"), F.lit(-1)).between(50, 100)).cast("int").alias("con_score"),
                                           F.coalesce(F.sum(F.when(F.col("nivel_num").isNotNull(), F.col("n"))), F.lit(0)).alias("con_nivel"), ordered.cast("int").alias("en_orden"))


@league_query("G9_ft_score_ml")
def _(L):
    return scoring.score_players(L.tb_player_season_stats, L.squad_history, L.as_of)
