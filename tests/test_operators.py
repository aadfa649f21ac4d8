"""Relational properties: nothing lost in splits, exact ranks under skew, resolution against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from matchloom.operators import aggregates, joins, quality, ranges, ranking, resolve
from matchloom.plans import questions, routing, views


def test_match_split_keeps_every_row(spark):
    df = spark.createDataFrame([(i, f"n{i % 7}" if i % 5 else None) for i in range(100)], "i int, k string")
    dim = spark.createDataFrame([("n1", 1), ("n2", 2)], "k string, v int")
    ok, bad = joins.match_split(df, dim, {"k": "k"}, "SIN", ["v"])
    assert ok.count() + bad.count() == 100
    assert bad.select("razon_rechazo").distinct().collect()[0][0] == "SIN"


def test_rank_table_is_exact_with_a_hot_group(spark):
    rnd = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 50}", rnd.choice([None, rnd.randint(0, 9)]), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    order = [("v", "desc"), ("id", "asc")]
    want = df.withColumn("posicion", F.row_number().over(Window.partitionBy("g").orderBy(*ranking.sort_columns(order))))
    got = ranking.rank_table(df, ["g"], order)
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == 6000


def test_rank_table_spreads_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise("rest").alias("g"), "id")
    keyed = df.withColumn("_k", F.struct("g", "id"))
    bounds = [(("hot", i * 100),) for i in range(1, 50)]
    listed = spark.createDataFrame([(bounds_row,) for bounds_row in [[b[0] for b in bounds]]], "b array<struct<g string, id bigint>>")
    cut = ranges.with_range(keyed, listed.scalar(), 50).select("g", "id", F.col("_cut").alias("c"))
    assert all(r.c == min(49, r.id // 100) for r in cut.filter("g = 'hot'").collect())
    got = ranking.rank_table(df, ["g"], [("id", "desc")], splits=40)
    want = df.withColumn("posicion", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("id"))))
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == 5000


def test_rank_table_of_equal_rows_and_small_input(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), (None, None, 3)], "g string, v int, id int")
    got = ranking.rank_table(df, ["g"], [("v", "desc"), ("id", "asc")]).collect()
    assert sorted((r.id, r.posicion) for r in got) == [(1, 1), (2, 2), (3, 1)]


def test_streaks(spark):
    results = "GGPGGGEP"
    df = spark.createDataFrame([("t", i, r) for i, r in enumerate(results)], "t string, d int, r string")
    got = ranking.streaks(df, ["t"], [("d", "asc")], F.col("r") != "P").collect()
    assert sorted((r.desde, r.hasta, r.racha) for r in got) == [(1, 2, 2), (4, 7, 4)]


@pytest.mark.parametrize("splits", [2, 16, 50])
def test_streaks_over_many_ranges(spark, splits):
    """Streaks that span several ranges, a group with most rows, one without hits, NULL groups and conditions."""
    rnd = random.Random(7)
    groups = {"hot": 3000, "always": 900, "never": 200, None: 400, **{f"g{i}": 3 for i in range(200)}}
    rows, want = [], []
    for g, n in groups.items():
        results = [g == "always" or (g != "never" and (i // 170 % 2 == 0 or rnd.random() < 0.5) or None) for i in range(n)]
        at = 0
        for hit, run in itertools.groupby(results):
            size = len(list(run))
            want += [(g, at + 1, at + size, size)] if hit else []
            at += size
        rows += [(g, i, r) for i, r in enumerate(results)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, d int, r boolean").repartition(7)
    got = ranking.streaks(df, ["g"], [("d", "asc")], F.col("r"), splits)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    sums = ranges.running(df.drop("r"), ["g"], F.col("d"), {"total": F.col("d").cast("long"), "x": F.xxhash64("d")}, {"x": "bit_xor"}, splits)
    w = Window.partitionBy("g").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("g", "d", F.sum(F.col("d").cast("long")).over(w).alias("total"), F.bit_xor(F.xxhash64("d")).over(w).alias("x"))
    assert sums.select(*plain.columns).exceptAll(plain).count() == 0 and sums.count() == len(rows)
    alone = ranges.running(df.drop("r"), [], F.struct("g", "d"), {"n": F.lit(1).cast("long")}, splits=splits)
    assert sorted(r.n for r in alone.collect()) == list(range(1, len(rows) + 1))


def test_ranges_move_rows_once(spark):
    df = spark.range(20000).select((F.col("id") % 3).alias("g"), "id")
    rows, n = ranges.placed(df.withColumn("_k", F.struct("g", "id")), 16)
    w = Window.partitionBy("_cut", "g").orderBy("_k")
    plan = rows.withColumn("a", F.row_number().over(w)).groupBy("_cut", "g").count()._jdf.queryExecution().executedPlan().toString()
    assert n == 16 and plan.count("Exchange shufflepartitionidpassthrough") == 1 and "Exchange hashpartitioning" not in plan


def test_minmax_bounds_and_flat_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 5.0), ("c", None)], "g string, v double")
    got = sorted(((r.g, r.score_100) for r in ranking.minmax_by(df, "g", "v").collect()), key=repr)
    assert got == [("a", 0.0), ("a", 100.0), ("b", 50.0), ("b", 50.0), ("c", None)]


def test_key_profile_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    r = quality.profile_key(df, "k", "t").first()
    assert (r.total, r.nulos_pk, r.duplicados_pk, r.status) == (5, 2, 2, "WARN")


def _grams(s):
    s = s.replace(" ", "_")
    return {s[i:i + 2] for i in range(len(s) - 1)}


def _best(t, names, threshold=0.55):
    if t in names:
        return t
    inside = sorted((n for n in names if t in n or n in t), key=lambda n: (-len(n), n))
    if inside:
        return inside[0]
    scored = [(-len(_grams(t) & _grams(n)) / len(_grams(t) | _grams(n)), n) for n in names]
    good = sorted(x for x in scored if -x[0] > threshold)
    return good[0][1] if good else None


def test_fuzzy_lookup_equals_brute_force(spark):
    names = ["alianza lima", "sporting cristal", "universitario", "cienciano", "melgar", "sport boys", "sport huancayo", "cesar vallejo"]
    rnd = random.Random(3)
    texts = set()
    for n in names:
        for _ in range(25):
            chars = list(n)
            for _ in range(rnd.randint(0, 4)):
                at = rnd.randrange(len(chars))
                rnd.choice([lambda: chars.pop(at) if len(chars) > 3 else None, lambda: chars.insert(at, rnd.choice("aeiou ")), lambda: chars.__setitem__(at, "x")])()
            texts.add("".join(chars).strip())
    texts |= {"zzz", "el melgar fc", "lima", "sport"}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "t string")
    got = {r.t: r.resuelto for r in resolve.fuzzy_lookup(df, spark.createDataFrame([(n,) for n in names], "nombre string"), "t").collect()}
    assert got == {t: _best(t, names) if len(t) >= 3 else None for t in texts}


def test_mentions_are_consumed_longest_first(spark):
    names = spark.createDataFrame([("Cristal",), ("Sporting Cristal",), ("Boys",), ("abc",)], "nombre string")
    df = spark.createDataFrame([("Sporting Cristal vs boys y cristal",), ("sporting cristal",), ("abc nada",), (None,)], "q string")
    got = {r.q: list(r.menciones) for r in resolve.extract_mentions(df, names, "q").collect()}
    assert got == {"Sporting Cristal vs boys y cristal": ["sporting cristal", "cristal", "boys"], "sporting cristal": ["sporting cristal"], "abc nada": [], None: []}


def test_versus_pairs(spark):
    names = spark.createDataFrame([("alianza lima",), ("universitario",)], "nombre string")
    asked = {
        "compara alianza lima vs universitario": ("universitario", "alianza lima"),
        "dame a Paolo Guerrero vs Alex Valera, grafico radar": ("paolo guerrero", "alex valera"),
        "compara aliza lima vs universitarios": ("alianza lima", "universitario"),
        "ultimo partido entre juan perez y luis gomez para hoy": ("juan perez", "luis gomez"),
        "tabla de posiciones": (None, None),
    }
    df = spark.createDataFrame([(q,) for q in asked], "q string")
    got = {r.q: (r.entidad_a, r.entidad_b) for r in routing.extract_vs_pair(df, names, "q").collect()}
    assert got == asked


def test_names_in_one_pattern_equal_the_join(spark):
    """Names within names, names that begin alike, signs of patterns, and texts without any."""
    names = ["sporting", "sporting cristal", "cristal", "stal", "a.c*", "(x)+", "árbol", "boys boys", "1", "11", "111"]
    texts = ["Sporting Cristal 2020", "sport", "a.c* y (x)+ abc", "ÁRBOL boys boys boys", "1111", "", None, "sporting sporting cristal"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, q string")
    known = spark.createDataFrame([(n,) for n in names], "nombre string")
    want = {i: sorted((n for n in names if n in (t or "").lower()), key=lambda n: (-len(n), n)) for i, t in enumerate(texts)}
    for most in (100, 3):
        found = resolve.with_offers(df, known, "q", shortest=1, most=most)
        assert {r.i: list(r._offers or []) for r in found.collect()} == want
    assert [r._offers or [] for r in resolve.with_offers(df, known.limit(0), "q").collect()] == [[]] * len(texts)


def test_players_named_by_words(spark):
    names = spark.createDataFrame([("Juan Carlos Pérez",), ("Luis Gómez",), ("Al Bo",)], "nombre string")
    asked = ["juan pérez", "pérez luis", "gómez", "al", "zz", "juan de la carlos", " "]
    df = spark.createDataFrame([(a,) for a in [*asked, None]], "p string")
    assert {r.p for r in resolve.named_by_words(df, names, "p").collect()} == {"juan pérez", "gómez", "al", "juan de la carlos"}


def test_questions_are_routed_from_their_text(spark):
    teams = spark.createDataFrame([("alianza lima",), ("universitario",)], "nombre string")
    players = spark.createDataFrame([("Paolo Guerrero",), ("Alex Valera",)], "nombre string")
    asked = {
        "compara alianza lima vs universitario en 2023": ("vs", "universitario", "alianza lima", "universitario", ["vs_equipos", "vs_detalle_estadisticas", "partido_rival"]),
        "compara aliza lima vs universitarix": ("vs", "alianza lima", "universitario", None, ["vs_equipos", "vs_detalle_estadisticas"]),
        "Paolo Guerrero vs Alex Valera": ("vs", "paolo guerrero", "alex valera", None, ["vs_jugadores"]),
        "Juan Reynoso vs Guillermo Salas": ("vs", "juan reynoso", "guillermo salas", None, ["vs_entrenadores"]),
        "entrenador Reynoso vs Salas": ("vs_entrenadores", "entrenador reynoso", "salas", None, ["vs_entrenadores"]),
        "resultado del partido entre melgar y alianza lima": ("partido_rival", "melgar", "alianza lima", "alianza lima", ["partido_rival"]),
        "¿vs?": ("tabla_posiciones", None, None, None, ["tabla_posiciones"]),
        "plantel de Alianza Lima": ("plantilla_equipo", None, None, "alianza lima", ["plantilla_equipo"]),
        None: ("tabla_posiciones", None, None, None, ["tabla_posiciones"]),
    }
    df = spark.createDataFrame([(q,) for q in [*asked, "Paolo Guerrero vs Alex Valera"]], "q string")
    out = routing.route_questions(df, "q", teams, players, this_year=F.lit(2024)).collect()
    assert len(out) == len(asked) + 1
    assert {r.q: (r.ruta, r.entidad_a, r.entidad_b, r.equipo, list(r.objetivos)) for r in out} == asked


def test_no_shuffle_of_routing_carries_the_text(spark):
    df = spark.range(100).select("id", F.concat(F.lit("compara uno vs dos "), F.col("id").cast("string")).alias("q")).withColumn("q", F.concat("q", F.lit(" en 2023")))
    out = routing.route_questions(df, "q", spark.createDataFrame([("alianza lima",)], "nombre string"), this_year=F.lit(2024)).select("id", "ruta", "entidad_a")
    plan = out._jdf.queryExecution().optimizedPlan()
    joins = [plan]
    while joins:
        node = joins.pop()
        if node.nodeName() == "Join":
            assert "q" not in [node.left().output().apply(i).name() for i in range(node.left().output().size())]
        joins += [node.children().apply(i) for i in range(node.children().size())]


def test_covariances_of_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), (rng.normal(size=5) + 1e6).tolist()) for k in rng.integers(0, 3, 300)]
    extra = [(0, None), (1, [1.0, None, 2.0, 3.0, 4.0]), (2, [1.0]), (2, []), (1, [float("nan")] * 5)]
    df = spark.createDataFrame(rows + extra + [(None, rows[0][1])], "k int, v array<double>").repartition(7)
    got = {(r.k, r.i, r.j): r for r in aggregates.covariances_of_vectors(df, "k", "v").collect()}
    assert len(got) == 4 * 15
    for k in range(3):
        x = np.array([v for g, v in rows if g == k])
        c = np.cov(x.T, bias=True)
        for i in range(5):
            for j in range(i, 5):
                r = got[k, i, j]
                assert r.n == len(x) and abs(r.cov - c[i, j]) < 1e-9 and abs(r.media_i - x[:, i].mean()) < 1e-6
    assert got[None, 0, 0].n == 1 and abs(got[None, 0, 0].cov) < 1e-9
    assert aggregates.covariances_of_vectors(df.limit(0), "k", "v").collect() == []


def test_url_rules(spark):
    df = spark.createDataFrame([(u,) for u in ["", None, "http://x/default.jpg", "ok.jpg?1", "gone.jpg?1", "moved.jpg?1", "odd.jpg?1", "new.jpg?1"]], "foto_url string")
    status = spark.createDataFrame([("ok.jpg?1", 200), ("gone.jpg?1", 404), ("gone.JPG?1", 404), ("moved.jpg?1", 404), ("moved.JPG?1", 200), ("odd.jpg?1", 503)], "url string, status int")
    got = [r.foto_url for r in resolve.resolve_urls(df, status, default="D").collect()]
    assert sorted(got) == sorted(["D", "D", "http://x/default.jpg", "ok.jpg?1", "D", "moved.JPG?1", "odd.jpg?1", "new.jpg?1"])


def test_formations(spark):
    slots = views.formation_slots(spark)
    assert slots.count() == 88 and slots.groupBy("id_formacion").count().filter("count <> 11").count() == 0
    df = spark.createDataFrame([("4-4-2", None), ("4 3 3", "equilibrado"), (None, "defensivo"), (None, None), ("4-3-3", None)], "f string, e string")
    assert [r.id_formacion for r in questions.formation_for(df, "f", "e").collect()] == [4, 5, 6, 1, 1]
