"""Registered queries: contract, and a spread of them compared with SQL on the smallest tables."""

import pytest

from checks.all import QUERIES, SQL
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
SAMPLE = ["E20_surrogate_keys", "B02_md_equipos", "B07_hm_entrenadores_equipo", "B11_hm_tablas_clasificacion", "B12_hm_campeones", "G1_dm_equipos",
          "V04_posiciones", "V05_partidos_equipo", "Q01_tabla_posiciones", "Q09_vs_equipos", "Q22_mejor_xi", "Q32_kpi", "W11_streaks", "X01_incremental_upsert"]


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 250


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    note, good = compare(spark, connect(SF), name, QUERIES[name], SQL.get(name), SF)
    assert good, note


def test_two_rows_per_match_and_eleven_slots(spark):
    assert QUERIES["V05_partidos_equipo"](spark, SF).count() == 2 * QUERIES["G4_ft_partidos_detalle"](spark, SF).count()
    eleven = QUERIES["Q22_mejor_xi"](spark, SF)
    assert eleven.count() <= 11 and eleven.groupBy("slot").count().filter("count > 1").count() == 0
