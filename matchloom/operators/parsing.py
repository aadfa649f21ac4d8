"""Rows out of HTML text and untyped cell lists, with array functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text
from . import html

STANDINGS = ["posicion", "equipo", "puntos", "partidos_jugados", "partidos_ganados", "partidos_empatados",
             "partidos_perdidos", "goles_favor", "goles_contra"]


def _others(df: DataFrame, c: str) -> list[Column]:
    return [F.col(f"`{x}`") for x in df.columns if x != c]


def html_rows(df: DataFrame, c: str) -> DataFrame:
    """One row per table row: number of the table in the page (by start tag), number of the row in the table, cells.

    A table inside another is a table of its own; its text belongs to no cell of the outer one. Missing end tags of tables,
    rows and cells are implied. NULL and empty pages give no rows."""
    listed = df.select(*_others(df, c), F.explode(html.tables(F.col(c))).alias("_t"))
    return listed.select(*_others(df, c), F.col("_t.lugar").alias("tabla"), F.posexplode(html.rows(F.col("_t.html"))).alias("fila", "celdas"))


def html_list_items(df: DataFrame, c: str) -> DataFrame:
    """One row per item of a `ul` or `ol`: number of the list in the page, number of the item in the list, text.

    A list inside an item is a list of its own. Missing end tags of lists and items are implied."""
    levels = F.filter(html.own_levels(html.shown(F.col(c)), "ul|ol"), lambda t: t["lugar"].isNotNull())
    listed = df.select(*_others(df, c), F.explode(levels).alias("_t"))
    listed = listed.select(*_others(df, c), F.col("_t.lugar").alias("lista"), F.posexplode(html.items(F.col("_t.html"))).alias("item", "_i"))
    return listed.select(*_others(df, c), "lista", "item", html.plain_text(F.col("_i.html")).alias("texto"))


def _whole(c: Column) -> Column:
    return F.when(c.rlike(r"^\d+$"), c.try_cast("int"))


def html_table_rows(df: DataFrame, c: str) -> DataFrame:
    """Standings rows of tables whose header names position, team and points; bad rows are dropped."""
    keep = [x for x in df.columns if x != c]

    def headed(t: Column) -> Column:
        head = F.lower(F.array_join(F.get(t["filas"], F.lit(0)), " "))
        return head.contains("pos.") & head.contains("equipo") & head.contains("pts.")

    read = F.transform(html.tables(F.col(c)), lambda t: F.struct(t["lugar"].alias("tabla"), html.rows(t["html"]).alias("filas")))
    marked = df.select(*_others(df, c), F.explode(F.filter(read, headed)).alias("_t"))
    body = (marked.select(*_others(df, c), "_t.tabla", F.posexplode("_t.filas").alias("fila", "_c"))
            .filter((F.col("fila") > 0) & (F.size("_c") >= 9)))
    place = F.regexp_replace(F.get("_c", F.lit(0)), "[^0-9]", "").try_cast("int")
    team = F.trim(F.regexp_replace(F.get("_c", F.lit(1)), r"\s*\([^)]*\)\s*", ""))
    numbers = [F.coalesce(_whole(F.get("_c", F.lit(i))), F.lit(0)).alias(STANDINGS[i]) for i in range(2, 9)]
    out = body.select(*[F.col(f"`{x}`") for x in keep], "tabla", "fila", place.alias("posicion"), team.alias("equipo"), *numbers)
    return out.filter(F.col("posicion") > 0).withColumn(
        "diferencia_goles", F.col("goles_favor") - F.col("goles_contra"))


def html_stat_pairs(df: DataFrame, c: str) -> DataFrame:
    """Map column `estadisticas`: '<title>_local' and '<title>_visitante' for each statistic with two boxes.

    A statistic is a list item whose class holds "Stat", with a title span and at least two box divs, whatever stands inside
    them; of a title that comes again, the last one counts."""
    found = F.flatten(F.transform(html.own_levels(html.shown(F.col(c)), "ul|ol"), lambda t: html.items(t["html"])))

    def entry(item: Column) -> Column:
        titles = html.elements(item["html"], "span", "StatTitle")
        boxes = html.elements(item["html"], "div", "StatBox")
        return F.struct(html.plain_text(F.get(titles, F.lit(0))).alias("t"), F.transform(boxes, html.plain_text).alias("b"))

    def pairs(e: Column) -> Column:
        two = F.array(F.struct(F.concat(e["t"], F.lit("_local")).alias("key"), F.get(e["b"], F.lit(0)).alias("value")),
                      F.struct(F.concat(e["t"], F.lit("_visitante")).alias("key"), F.get(e["b"], F.lit(1)).alias("value")))
        return F.when((e["t"] != "") & (F.size(e["b"]) >= 2), two).otherwise(F.slice(two, 1, 0))

    def last_of_each(all_pairs: Column) -> Column:
        names = F.array_distinct(F.transform(all_pairs, lambda p: p["key"]))
        return F.map_from_entries(F.transform(names, lambda k: F.element_at(F.filter(all_pairs, lambda p: p["key"] == k), -1)))

    read = F.transform(F.filter(found, lambda i: html.has_class(i["marca"], "Stat")), lambda i: html.bound(entry(i), pairs))
    return df.select(*_others(df, c), html.bound(F.flatten(read), last_of_each).alias("estadisticas"))


KEEPER_CELLS = 15
# --- Fixed values: cell numbers of the two season layouts -------------------------
FIELD_LAYOUT = {
    "partidos_jugados": 2, "titularidades": 3, "ppp": 4, "goles": 5, "asistencias": 6, "tarjetas_amarillas": 8,
    "tarjeta_amarilla_roja": 9, "tarjetas_rojas": 10, "entrada_suplente": 11, "salida_suplente": 12,
    "penaltis_anotados": 13, "goles_en_contra": None, "partidos_imbatido": None, "min_por_gol": 14,
    "minutos_jugados": 15,
}
KEEPER_LAYOUT = {
    "partidos_jugados": 2, "titularidades": 3, "ppp": 4, "goles": None, "asistencias": None, "tarjetas_amarillas": 8,
    "tarjeta_amarilla_roja": 9, "tarjetas_rojas": 10, "entrada_suplente": None, "salida_suplente": None,
    "penaltis_anotados": None, "goles_en_contra": 12, "partidos_imbatido": 13, "min_por_gol": None,
    "minutos_jugados": 14,
}


def layout_by_arity(df: DataFrame, cells: str) -> DataFrame:
    """Named statistics from a cell list whose layout depends on its length.

    The fields are read inside array functions: as plain columns they, and the filter with whatever the cells are made of, become one
    generated method too long for the JVM to compile, which then takes several times as long."""
    def read(c: Column, layout: dict) -> list[Column]:
        out = []
        for name, at in layout.items():
            parse = text.stat_decimal if name == "ppp" else text.stat_int
            zero = F.lit(0.0) if name == "ppp" else F.lit(0)
            out.append((zero if at is None else parse(F.get(c, F.lit(at)))).alias(name))
        return out

    def contest(c: Column) -> Column:
        return F.trim(F.get(c, F.lit(1)))

    def usable(c: Column) -> Column:
        return (F.size(c) >= 3) & (contest(c) != "") & ~contest(c).rlike(r"^\d+$") & ~contest(c).contains("/")

    def named(c: Column) -> Column:
        head = contest(c).alias("competencia")
        return F.when(F.size(c) == KEEPER_CELLS, F.struct(head, *read(c, KEEPER_LAYOUT))).otherwise(F.struct(head, *read(c, FIELD_LAYOUT)))

    keep = [F.col(f"`{x}`") for x in df.columns if x != cells]
    found = F.transform(F.filter(F.array(F.col(cells)), usable), named)
    return df.select(*keep, F.explode(found).alias("_s")).select(*keep, "_s.*")


def classify_cells(df: DataFrame, cells: str, value: str | None = None, flags: str | None = None) -> DataFrame:
    """Squad fields recognised by the form of the cells, wherever they stand in the row."""
    c = F.transform(F.col(cells), lambda x: F.trim(x))
    later = F.slice(c, 3, F.greatest(F.size(c), F.lit(0)))

    def is_date(x: Column) -> Column:
        return x.rlike(r"\d{2}/\d{2}/\d{4}")

    feet = F.filter(c, lambda x: F.lower(x).isin(list(fixed.FOOT_NAMES)))
    out = {
        "numero": F.coalesce(F.nullif(F.get(c, F.lit(0)), F.lit("")), F.lit("Sin Número")),
        "fecha_nacimiento": F.coalesce(F.get(F.filter(later, is_date), F.lit(0)), F.lit("")),
        "altura": F.coalesce(F.get(F.filter(c, lambda x: x.rlike(r"^\d,\d{2}m")), F.lit(0)), F.lit("")),
        "pie": F.coalesce(text.map_label(F.lower(F.get(feet, F.lit(0))), fixed.FOOT_NAMES), F.lit("")),
        "fecha_fichaje": F.coalesce(F.get(F.filter(later, is_date), F.lit(1)), F.lit("")),
    }
    if value is not None:
        out["valor_mercado"] = F.coalesce(F.trim(value), F.lit(""))
    if flags is not None:
        out["nacionalidad"] = F.array_join(F.filter(F.col(flags), lambda x: x != ""), ", ")
    keep = [F.col(f"`{x}`") for x in df.columns if x not in (cells, value, flags)]
    return df.filter(F.size(cells) >= 5).select(*keep, *[v.alias(k) for k, v in out.items()])
