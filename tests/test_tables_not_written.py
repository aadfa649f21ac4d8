"""Tables that one later table reads, or that follow from stored ones in a projection, are not written."""

from checks import league
from matchloom.plans import gold


def test_scores_follow_from_stored_features(spark, folder):
    one, again = league.League(spark, folder), league.League(spark, folder)
    one.__dict__["simple_score"] = spark.range(3)
    assert one.tb_simple_score is one.simple_score and again.tb_simple_score is one.simple_score
    assert not one.is_written("simple_score")


def test_statistics_of_competitions_go_on_as_they_are_joined(spark, folder, monkeypatch):
    spark.range(95).write.parquet(f"{folder}/lineitem.parquet")
    seen = []
    monkeypatch.setattr(gold, "ROWS_A_TASK", 10)
    monkeypatch.setattr(gold, "player_season_stats", lambda stats, players, squads, dim, as_of, tasks: seen.append((stats, tasks)) or stats)
    tables = league.League(spark, folder)
    tables.__dict__ |= {c: spark.range(2) for c in ("tb_players", "tb_squads", "tb_dim")} | {"player_stats_split": (spark.range(4), spark.range(0))}
    assert tables.player_season_stats is tables.player_stats_split[0] and seen[0][1] == 19
    assert not tables.is_written("player_stats")
    # The table is read where it is written already.
    written = tables.stored("player_stats", lambda: spark.range(7))
    again = league.League(spark, folder)
    again.__dict__ |= {c: spark.range(2) for c in ("tb_players", "tb_squads", "tb_dim")} | {"player_stats_split": (spark.range(4), spark.range(0))}
    again.player_season_stats
    assert seen[1][0].count() == written.count() == 7
