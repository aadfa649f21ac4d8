"""Scalar functions on the literal edge cases: NULL, blanks, placeholders, accents, malformed text."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from matchloom.functions import dates, jsonx, measures, text


def run(spark, values, build):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, c string").select("i", build(F.col("c")).alias("v"))
    return [r["v"] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("value, wanted", [
    ("390 mil €", "390000"), ("18,70 mill. €", "18700000"), ("€502k", "502000"), ("€16.05m", "16050000"), ("523000", "523000"),
    ("0,0", "0"), ("", "0"), (None, "0"), ("sin informacion", "0"), ("-", None), ("No disponible", None)])
def test_money(spark, value, wanted):
    assert run(spark, [value], text.money) == [None if wanted is None else Decimal(wanted)]


def test_money_text_passes_other_text_through(spark):
    assert run(spark, ["390 mil €", "No disponible", "", None, "1,5 mill. €", "Milan"], text.money_text) == [
        "390000", "No disponible", "", None, "1500000", "Milan"]


def test_names_fold_accents(spark):
    assert run(spark, ["  ÁÉÍÓÚ Ñandú ", "Zé  Ricardo", None, ""], text.norm_name) == ["aeiou nandu", "ze  ricardo", None, ""]


def test_scores(spark):
    values = ["2 - 1", "2-1", "Sin jugar", "1-", "", None]
    assert run(spark, values, lambda c: text.score_side(c, 1)) == [2, 2, None, None, None, None]
    assert run(spark, values, lambda c: text.score_side(c, 2, 0)) == [1, 1, 0, 0, 0, 0]
    assert run(spark, values, text.valid_score)[2:] == ["sin informacion"] * 4


def test_percentages(spark):
    assert run(spark, ["7 (64 %)", "10 (0 %)", "7", "64%", "", None], text.pct) == [0.64, 0.0, 0.0, 0.64, 0.0, 0.0]


def test_heights(spark):
    values = ["1,85 m", "1.85m", "-", "n/a", "0", None, "alto"]
    assert run(spark, values, text.height) == [1.85, 1.85, 0.0, 0.0, 0.0, 0.0, 0.0]
    assert run(spark, values, lambda c: text.height(c, None)) == [1.85, 1.85, None, None, None, None, None]


def test_dates(spark):
    values = ["15-03-2024", "Friday, March 1", "Friday, March 1 2024", "99/99/2020", "Sin fecha", "", None]
    assert run(spark, values, lambda c: dates.match_date(c, F.lit(2023))) == [
        dt.date(2024, 3, 15), dt.date(2023, 3, 1), dt.date(2024, 3, 1), None, None, None, None]
    assert run(spark, ["31/12/2025", "99/99/2020", "31/02/2020", "", None], dates.date_or_null) == [dt.date(2025, 12, 31), None, None, None, None]
    assert run(spark, ["10/05/1990 (34)", "x", None], dates.birth_date) == [dt.date(1990, 5, 10), None, None]


def test_spanish_dates(spark):
    day = F.lit("2024-01-31").cast("date")
    assert run(spark, ["15 de marzo de 2024", "sábado, 3 de mayo", "2024-3-5", "5-3-2024", "hoy", "mañana", "N/A", None],
               lambda c: dates.spanish_date(c, F.lit(2023), day)) == [
        "15-03-2024", "03-05-2023", "05-03-2024", "05-03-2024", "31-01-2024", "01-02-2024", "N/A", None]


def test_counters_and_small_text(spark):
    assert run(spark, ["1.014'", "-", "", None, "2,215", "x", "12 "], text.stat_int) == [1014, 0, 0, 0, 2215, 0, 12]
    assert run(spark, ["173 días", "3 days", "9", None], text.strip_unit) == ["173", "3", "9", None]
    assert run(spark, ["Brasil, Italia", "Perú", "", None], lambda c: text.nth_item(c, 2)) == ["Italia", None, None, None]
    assert run(spark, ["12 (34 %)", "34 %", "7", "7.5", "-3", "abc", None], text.number_text) == [12.0, 34.0, 7.0, 7.5, -3.0, None, None]
    assert run(spark, ["a.jpg?x", "a.JPG?x", "a.png", None], text.toggle_ext) == ["a.JPG?x", "a.jpg?x", "a.png", None]
    assert run(spark, ["true", "False", "x", None], text.bool_or_false) == [True, False, False, False]
    assert run(spark, ["", "08/04/2026", "-", None], text.is_active) == [1, 0, 1, 1]


def test_rates_without_minutes(spark):
    df = spark.createDataFrame([(3, 0), (3, 270), (0, 90)], "g int, m int")
    got = df.select(measures.per90("g", "m").alias("a"), measures.minutes_per_goal("m", "g").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(0.0, 0), (1.0, 90), (0.0, 0)]


def test_dynamic_json_uses_all_rows(spark):
    rows = [(i, '{"A": 1}') for i in range(200)] + [(999, '7 [{"A": 2, "Late": "x", "Sub": [{"Q": 5}, {"Q": 6}]}]')]
    out = jsonx.expand_dynamic(spark.createDataFrame(rows, "i int, data string"), "data")
    assert set(out.columns) == {"i", "a", "late", "sub_q"}
    assert out.filter("i = 999").first().asDict() == {"i": 999, "a": "2", "late": "x", "sub_q": "5"}


def test_words_found_in_one_pass(spark):
    import random

    rnd = random.Random(4)
    listed = ["ab", "abc", "abcd", "b c", " dt ", "dt ", "c", "xi", "g/e/p", "año", "b"]
    texts = ["".join(rnd.choice("abcdtxigep/ ñ") for _ in range(rnd.randint(0, 40))) for _ in range(400)] + ["abcd b c dt g/e/p año", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.words_found("t", listed).alias("f"))
    got = df.select("t", *[text.any_found("f", listed, [w, "zz"]).alias(f"w{k}") for k, w in enumerate(listed)]).collect()
    assert all(r[f"w{k}"] == (None if r["t"] is None else w in r["t"]) for r in got for k, w in enumerate(listed))


def test_keys_that_are_data_stay_in_a_map(spark):
    """100,000 different keys: numbered ones and rare ones are kept in a map, frequent ones become columns."""
    numbered = spark.range(50000).select("id", F.concat(F.lit('{"a": "x", "b": [{"c": 1}], "id_'), F.col("id").cast("string"), F.lit('": "v"}')).alias("data"))
    words = spark.range(50000, 100000).select("id", F.concat(F.lit('{"a": "y", "'), F.translate(F.col("id").cast("string"), "0123456789", "qwertyuiop"), F.lit('": "w"}')).alias("data"))
    out = jsonx.expand_dynamic(numbered.unionByName(words), "data", most=20)
    assert len(out.columns) <= 1 + 20 + 1 and {"id", "a", "b_c", "otros"} <= set(out.columns)
    plain = [c for c in out.columns if c not in ("id", "a", "b_c", "otros")]
    kept = out.select(F.sum(F.size("otros")).alias("rest"), *[F.count(c).alias(c) for c in plain], F.count("a").alias("a"), F.count("b_c").alias("b_c")).first()
    assert kept["rest"] + sum(kept[c] for c in plain) == 100000 and kept["a"] == 100000 and kept["b_c"] == 50000
    few = jsonx.expand_dynamic(numbered.limit(50), "data")
    assert "otros" not in few.columns and len(few.columns) == 1 + 2 + 50
