"""Times the headline queries on one machine and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "A01_season_totals", "A02_player_totals", "A06_distinct_counts", "A12_key_profile", "A17_contradicting_rows", "B04_md_plantillas",
    "B05_hm_plantillas_equipo", "B09_hm_partidos", "B11_hm_tablas_clasificacion", "B13_hm_estadisticas_jugadores", "E09_money", "G3_ft_rendimiento_acumulado",
    "G4_ft_partidos_detalle", "G8_ft_estadisticas_jugadores", "J03_any_of_three_names", "J04_two_roles", "J05_match_split", "K05_merge_upsert", "N03_dynamic_keys",
    "Q01_tabla_posiciones", "Q03_eficiencia_historica", "Q08_mayor_goleada", "Q14_top_goleadores", "Q16_score_ml", "Q22_mejor_xi", "U01_unpivot_roles", "V04_posiciones",
    "V05_partidos_equipo", "V08_once_ponderado", "W01_latest_row", "W02_latest_non_blank", "W03_league_position", "W04_dense_rank", "W09_minmax_scale", "W11_streaks",
    "Y02_intents_and_route", "Y04_mentions", "Y05_versus_pair", "G9_ft_score_ml", "X01_incremental_upsert",
]

# Tables written before the questions are timed, as a scheduled load would.
LAYERS = {
    "load_silver": ["catalog", "teams", "stadiums", "players", "squads", "coaches", "spells", "values", "matches", "match_stats", "standings",
                    "champions", "player_stats"],
    "load_gold": ["dim", "season_performance", "accumulated", "match_detail", "squad_history", "coach_history", "value_history", "player_season_stats"],
    "load_score": ["simple_score"],
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from checks.all import QUERIES
    from checks.league import League
    from matchloom.session import local_session

    spark = local_session(cores, "bench", "16g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("count(*)").collect()
    times = {}
    league = League(spark, sf)
    for layer, tables in LAYERS.items():
        start = time.time()
        for t in tables:
            getattr(league, f"tb_{t}")
        times[layer] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
