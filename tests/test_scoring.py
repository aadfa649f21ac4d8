"""First component against numpy, sign rule, level order."""

import numpy as np
from pyspark.sql import functions as F

from matchloom.operators import quantiles
from matchloom.plans import scoring

FEATS = {"A": ["x", "y", "z", "k"], "B": ["x", "y"]}


def frame(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=60)
    rows = [("A", i, float(b), float(-b + rng.normal() * 0.3), None if i == 7 else float(rng.normal()), 5.0) for i, b in enumerate(base)]
    rows += [("B", 100 + i, float(i), float(i * i), 0.0, 1.0) for i in range(5)] + [("C", 200, 1.0, 1.0, 1.0, 1.0)]
    return spark.createDataFrame(rows, "p string, id int, x double, y double, z double, k double")


def test_component_equals_numpy(spark):
    got = {r.id: (r.score_ml, r.var_explicada) for r in scoring.component_scores(frame(spark), "p", FEATS, {"A": "y", "B": "x"}).collect()}
    pdf = frame(spark).filter("p = 'A'").toPandas().fillna(0.0).sort_values("id")
    x = pdf[FEATS["A"]].to_numpy()
    dev = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(dev > 0, dev, 1.0)
    values, vectors = np.linalg.eigh(np.cov(z.T, bias=True))
    score = z @ vectors[:, -1]
    if np.corrcoef(score, pdf["y"])[0, 1] < 0:
        score = -score
    assert np.allclose([got[i][0] for i in pdf["id"]], score)
    assert np.isclose(got[0][1], values[-1] / values.sum())
    assert got[200] == (None, None)


def test_levels_follow_the_mean_score(spark):
    scored = scoring.component_scores(frame(spark), "p", FEATS, {"A": "x"})
    out = scoring.cluster_levels(scored, "p", FEATS)
    assert out.count() == scored.count()
    means = [r.m for r in out.filter("p = 'A'").groupBy("nivel_num").agg(F.avg("score_ml").alias("m")).orderBy("nivel_num").collect()]
    assert len(means) == 4 and means == sorted(means)
    assert out.filter("p = 'B' and nivel_num is not null").count() == 0
    assert {r.nivel for r in out.filter("p = 'A'").select("nivel").distinct().collect()} == {"Suplente", "Regular", "Bueno", "Elite"}


def test_levels_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(g, i, *map(float, rng.normal(size=3)), 1.0) for g, n in (("A", 700), ("B", 300), ("D", 5)) for i in range(n)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "p string, id int, x double, y double, z double, k double")
    feats = {"A": ["x", "y", "z"], "B": ["x", "y"], "D": ["x"]}
    scored = scoring.component_scores(df, "p", feats, {"A": "x", "B": "y"})
    levels = [sorted(map(tuple, scoring.cluster_levels(scored.repartition(n), "p", feats).select("p", "id", "x", "nivel_num").collect()), key=repr) for n in (2, 60)]
    assert levels[0] == levels[1] and len(levels[0]) == len(rows)
    assert {r[3] for r in levels[0] if r[0] == "D"} == {None} and {r[3] for r in levels[0] if r[0] == "B"} == {0, 1, 2, 3}


def test_exact_quantiles(spark):
    rng = np.random.default_rng(5)
    cases = [rng.normal(size=5001), rng.integers(0, 9, 4000).astype(float), np.exp(rng.normal(size=3000) * 100), np.array([7.0] * 50), np.array([1.0, 2.0]), np.array([-1.7e308, 1.7e308, 5.0]),
             np.concatenate([rng.normal(size=101), [np.inf] * 30, [-np.inf] * 20]), np.nextafter(1.0, 2) * np.ones(9)]
    for values in cases:
        df = spark.createDataFrame([(float(v),) for v in rng.permutation(values)] + [(None,), (float("nan"),)], "v double").repartition(5)
        for p in (0.5, 0.0, 0.31, 1.0):
            got, order = quantiles.exact_quantile(df, "v", p), np.sort(values)
            at = (len(values) - 1) * p
            low, high = order[int(np.floor(at))], order[int(np.ceil(at))]
            assert got == low or np.isclose(got, low + (high - low) * (at - np.floor(at)), rtol=1e-9), (values[:5], p)
    assert quantiles.exact_quantile(spark.createDataFrame([(None,)], "v double"), "v") is None


def test_summary_lists(spark):
    rows = [("a", "Elite", 500, 90.0), ("b", "Bueno", 900, 70.0), ("c", "Bueno", 901, 70.0), ("d", "Regular", 100, 60.0), ("e", "Suplente", 2000, 40.0), ("f", "Suplente", 1700, 10.0), ("g", None, 1800, 41.0)]
    df = spark.createDataFrame([(n, "T", 2024, "DEL", level, m, s) for n, level, m, s in rows], "jugador string, nombre_equipo string, temporada int, posicion_xi string, nivel string, minutos_jugados int, score_100 double")
    got = {(r.tipo, r.grupo): (r.jugadores, r.score_medio) for r in scoring.score_summary(df).collect()}
    assert {k for k in got if k[0] == "gema"} == {("gema", "a|T|2024|DEL"), ("gema", "b|T|2024|DEL")}
    assert {k for k in got if k[0] == "titular_bajo"} == {("titular_bajo", "e|T|2024|DEL")}
    assert got["nivel", "Sin nivel"] == (1, 41.0) and got["temporada", "2024"][0] == 7
