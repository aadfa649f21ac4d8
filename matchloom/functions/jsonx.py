"""JSON payload columns: lists of flat objects, nested lists, and named tables of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .text import ColumnLike, _c, strip_leading_index

_ROWS = "array<map<string,string>>"
_TABLES = "array<map<string,array<map<string,string>>>>"


def as_list_text(c: ColumnLike) -> Column:
    text = strip_leading_index(c)
    return F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))


def parse_map_list(c: ColumnLike) -> Column:
    """JSON object or list of objects -> array of maps; nested values stay JSON text."""
    return F.from_json(as_list_text(c), _ROWS)


def explode_items(df: DataFrame, c: str, name: str = "item") -> DataFrame:
    keep = [F.col(f"`{x}`") for x in df.columns if x != c]
    return df.select(*keep, F.explode_outer(F.col(c)).alias(name))


def _is_nested(value: Column) -> Column:
    return value.rlike(r"^\s*\[\s*\{")


def discover_keys(items: DataFrame, item: str = "item", most: int = 500, alike: int = 100) -> tuple[list[str], dict[str, list[str]], bool]:
    """Keys of a map column that become columns, the sub-keys of those holding lists of objects, and whether other keys remain.

    Keys that differ only in their digits and number more than `alike` are data written as keys, not columns. Of the others the `most`
    that stand in the most rows become columns (ties by name). Lists of objects are opened while their sub-keys together are at
    most `most`, those with the fewest first; another stays JSON text. All rows are counted, once; no more than `most` keys or
    sub-keys reach the driver.
    """
    entries = items.select(F.explode(F.map_entries(item)).alias("e")).select("e.key", "e.value")
    child = F.when(_is_nested(F.col("value")), F.from_json("value", _ROWS))
    subs = F.array_distinct(F.flatten(F.transform(child, F.map_keys)))
    counts = stored(entries.select("key", F.posexplode_outer(subs).alias("at", "sub")).groupBy("key", "sub")
                    .agg(F.count_if(F.coalesce(F.col("at") == 0, F.lit(True))).alias("n")))
    rows = counts.groupBy("key").agg(F.sum("n").alias("n")).withColumn("like", F.regexp_replace("key", r"\d+", "0"))
    data = rows.groupBy("like").agg(F.count(F.lit(1)).alias("k")).filter((F.col("k") > alike) & F.col("like").contains("0"))
    named = rows.join(data.select("like"), "like", "left_anti").orderBy(F.desc("n"), "key").limit(most)
    keys = sorted(r["key"] for r in named.select("key").collect())
    inner = counts.filter(F.col("key").isin(keys) & F.col("sub").isNotNull()) if keys else counts.limit(0)
    room, opened = most, []
    for r in inner.groupBy("key").agg(F.count(F.lit(1)).alias("k")).orderBy("k", "key").collect():
        if r["k"] <= room:
            room -= r["k"]
            opened.append(r["key"])
    nested: dict[str, list[str]] = {}
    for r in (inner.filter(F.col("key").isin(opened)).select("key", "sub").orderBy("key", "sub").collect() if opened else []):
        nested.setdefault(r["key"], []).append(r["sub"])
    return keys, nested, rows.count() > len(keys)


def expand_dynamic(df: DataFrame, c: str, keys: list[str] | None = None, nested: dict[str, list[str]] | None = None,
                   most: int = 500, alike: int = 100, rest: str = "otros") -> DataFrame:
    """One row per list element, one column per key; nested lists give `parent_child` of their first element.

    Without `keys` they are discovered (see discover_keys); keys that do not become columns are kept in a map column named `rest`,
    which is there only if there are such keys.
    """
    items = explode_items(df.withColumn(c, parse_map_list(c)), c)
    others = False
    if keys is None:
        keys, nested, others = discover_keys(items, most=most, alike=alike)
    nested = nested or {}
    base = [F.col(f"`{x}`") for x in items.columns if x != "item"]
    flat = [F.col("item").getItem(k).alias(k.lower()) for k in keys if k not in nested]
    deep = []
    for parent, subs in nested.items():
        text = F.col("item").getItem(parent)
        first = F.try_element_at(F.from_json(F.when(_is_nested(text), text), _ROWS), F.lit(1))
        deep += [first.getItem(s).alias(f"{parent.lower()}_{s.lower()}") for s in subs]
    if others:
        taken = F.array(*map(F.lit, keys)) if keys else F.array().cast("array<string>")
        deep.append(F.map_filter("item", lambda k, _: ~F.array_contains(taken, k)).alias(rest))
    return items.select(*base, *flat, *deep)


def explode_tables(df: DataFrame, c: str, keys: list[str], table_name: str = "tipo_tabla") -> DataFrame:
    """{'table': [row, ...], ...} -> one row per table row with the given keys as columns."""
    base = [F.col(f"`{x}`") for x in df.columns if x != c]
    tables = df.select(*base, F.explode_outer(F.from_json(as_list_text(c), _TABLES)).alias("_tables"))
    named = tables.select(*base, F.explode_outer("_tables").alias(table_name, "_rows"))
    rows = named.select(*base, table_name, F.explode_outer("_rows").alias("_row"))
    return rows.select(*base, table_name, *[F.col("_row").getItem(k).alias(k) for k in keys])
