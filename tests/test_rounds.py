"""Levels need few jobs, however many rounds the centres take."""

import numpy as np
from pyspark.sql import functions as F

from matchloom.plans import scoring

FEATS = {"A": ["x", "y", "z"], "B": ["x", "y"], "D": ["x"], "E": ["x", "y", "z"]}


def scored(spark):
    """One mass without gaps, in which centres move for long; one of few different rows; one too small; one of equal rows."""
    rng = np.random.default_rng(11)
    rows = [("A", i, *map(float, rng.normal(size=3))) for i in range(2500)]
    rows += [("B", 5000 + i, float(i % 6), float(i % 4 % 3), 0.0) for i in range(400)]
    rows += [("D", 6000 + i, float(i), 0.0, 0.0) for i in range(5)] + [("E", 7000 + i, 1.0, 2.0, 3.0) for i in range(30)]
    df = spark.createDataFrame(rows, "p string, id int, x double, y double, z double").repartition(4)
    return scoring.component_scores(df, "p", FEATS, {"A": "x"}).localCheckpoint()


def plain(group, k=4, unit=scoring.UNIT):
    """The rounds over all rows, one after the other, in whole numbers; first centres from the order of the score."""
    q = [[int(v) for v in r["q"]] for r in group]
    order = sorted(range(len(q)), key=lambda i: (group[i]["s"], group[i]["h"]))
    n = len(q)
    part = {i: max(j for j in range(k) if j == 0 or rank >= -(-j * n // k)) for rank, i in enumerate(order)}
    centres, rounds = None, 0
    while True:
        new = []
        for j in range(k):
            mine = [q[i] for i in range(n) if part[i] == j]
            new.append([(2 * sum(c) + len(mine)) // (2 * len(mine)) for c in zip(*mine)] if mine else centres[j])
        if new == centres:
            break
        centres, rounds = new, rounds + 1
        part = {i: min(range(k), key=lambda j: (sum((a - b) ** 2 for a, b in zip(q[i], centres[j])), j)) for i in range(n)}
    means = sorted((sum(group[i]["s"] for i in range(n) if part[i] == j) / sum(p == j for p in part.values()), j) for j in set(part.values()))
    number = {j: m for m, (_, j) in enumerate(means)}
    return {group[i]["id"]: number[part[i]] for i in range(n)}, rounds


def test_levels_in_few_jobs_are_those_of_all_rounds(spark):
    df = scored(spark)
    whole = F.transform("_z", lambda z: F.round(z * scoring.UNIT).cast("bigint"))
    rows = df.select("id", whole.alias("q"), F.round(F.col("score_ml") * scoring.UNIT).cast("bigint").alias("s")).withColumn("h", F.xxhash64("q"))
    expected, rounds = plain(rows.filter("id < 5000").collect())
    assert rounds > 10
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    got, jobs = [], []
    for most in (20_000, 300, 0):
        sc.setJobGroup(f"levels {most}", "")
        out = scoring.cluster_levels(df, "p", FEATS, most_open=most)
        jobs.append(len(tracker.getJobIdsForGroup(f"levels {most}")))
        got.append({r["id"]: r["nivel_num"] for r in out.select("id", "nivel_num").collect()})
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got[0] == got[1] == got[2] and len(got[0]) == 2935
    assert {i: v for i, v in got[0].items() if i < 5000} == expected
    assert jobs[0] < 45 and jobs[0] < jobs[2] and jobs[1] < jobs[2], jobs


def test_rounds_stop_at_their_limit(spark):
    df = scored(spark).filter("p in ('A', 'B')")
    few = [{r["id"]: r["nivel_num"] for r in scoring.cluster_levels(df, "p", FEATS, most_rounds=3, most_open=m).select("id", "nivel_num").collect()} for m in (20_000, 0)]
    assert few[0] == few[1]
    assert few[0] != {r["id"]: r["nivel_num"] for r in scoring.cluster_levels(df, "p", FEATS).select("id", "nivel_num").collect()}
