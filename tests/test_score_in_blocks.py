"""Covariances and levels come from blocks of rows: no lambda is evaluated row by row, and the scored rows are read once for the result."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from matchloom.operators import aggregates
from matchloom.plans import scoring


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_covariances_of_pairs_that_are_given(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)) * [1, 100, 1e-3] + [5, 1e6, 0]
    rows = [(["a", "b", None][i % 3], *[None if (i + j) % 7 == 0 else float(v) for j, v in enumerate(r)]) for i, r in enumerate(x)]
    rows += [("one", 1.0, None, 2.0), ("none", None, None, None), ("nan", 1.0, float("nan"), 2.0), ("nan", 2.0, 3.0, 4.0)]
    got = {r["g"]: r for r in aggregates.gram_by(spark.createDataFrame(rows, "g string, x double, y double, z double").repartition(7), "g", ["x", "y", "z"]).collect()}
    assert set(got) == {"a", "b", None, "one", "none", "nan"} and sum(r["n"] for r in got.values()) == len(rows)
    for g in ("a", "b", None):
        pdf = pd.DataFrame([r[1:] for r in rows if r[0] == g], columns=["x", "y", "z"])
        cov = pdf.cov(ddof=0, min_periods=1)
        for a, b in ("xx", "xy", "xz", "yy", "yz", "zz"):
            both = pdf[[a, b]].dropna().to_numpy()
            assert np.isclose(got[g][f"cov_{a}__{b}"], np.cov(both.T, bias=True)[0, 1], rtol=1e-9, atol=1e-15)
        assert np.allclose([got[g][f"mean_{c}"] for c in "xyz"], pdf.mean()) and cov.shape == (3, 3)
    assert got["one"]["cov_x__x"] == 0 and got["one"]["cov_x__y"] is None and got["one"]["mean_y"] is None
    assert got["none"]["n"] == 1 and got["none"]["mean_x"] is None
    assert np.isnan(got["nan"]["mean_y"]) and np.isnan(got["nan"]["cov_x__y"]) and got["nan"]["cov_x__z"] == 0.5


def test_millionths_are_rounded_as_spark_does(spark):
    values = [0.5, -0.5, 1.5, 2.5, 0.49999999999999994, -2.4999999999999996, 123456789.5, 1e12 + 0.5]
    df = spark.createDataFrame([(v / scoring.UNIT,) for v in values], "v double")
    expected = [r[0] for r in df.select(F.round(F.col("v") * scoring.UNIT).cast("bigint")).collect()]
    assert scoring._whole(np.array([v / scoring.UNIT for v in values])).tolist() == expected


def test_levels_are_found_in_blocks(spark):
    rows = [("A", float(i), float(i * i % 17)) for i in range(60)] + [("B", 1.0, 2.0), (None, 1.0, 1.0), ("A", None, 3.0)]
    df = spark.createDataFrame(rows, "p string, x double, y double")
    feats = {"A": ["x", "y"], "B": ["x"]}
    scored = scoring.component_scores(df, "p", feats, {"A": "x"})
    out = scoring.cluster_levels(scored, "p", feats)
    assert "lambda" not in plan(out) and "Union" not in plan(out)
    got = out.collect()
    assert len(got) == 63 and {r.nivel_num for r in got if r.p == "A"} == {0, 1, 2, 3}
    assert all(r.nivel is None and r.score_ml is None and r["_z"] is None for r in got if r.p != "A")
