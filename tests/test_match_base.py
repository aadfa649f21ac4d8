"""Matches, statistics, teams and coaches share one count of the line items."""

import datetime

from checks.league import League


def test_line_items_of_matches_are_counted_once(spark, folder):
    day = datetime.datetime(1996, 3, 4)
    spark.createDataFrame([(1, 10, "F", day), (2, 11, "P", day), (3, 12, "O", day), (None, 13, "O", day)], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(1, 7, 30.0), (1, 5, 20.0), (1, 5, 20.0), (2, None, 26.0), (4, 7, 1.0), (None, 7, 1.0)], "l_orderkey bigint, l_suppkey bigint, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    league = League(spark, folder)
    assert "lineitem" not in league.match_base._jdf.queryExecution().executedPlan().toString()
    rows = sorted((r["o_orderkey"], r["season"], r["lo"], r["hi"], r["gl"], r["gv"], r["q"]) for r in league.match_base.collect())
    assert rows == [(1, 1996, 5, 7, 1, 2, 70), (2, 1996, None, None, 1, 0, 26)]
    assert [c.inputFiles() == league.match_base.inputFiles() for c in (league.raw_matches, league.raw_match_stats, league.raw_coaches)] == [True] * 3
