"""Headers, projections and column-wise clean-up driven by column lists and schemas."""

from __future__ import annotations

import re
import unicodedata
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..functions.dates import iso_date


def _ascii(name: str) -> str:
    return unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[_ascii(c).lower().replace(" ", "_") for c in df.columns])


def clean_header(name: str) -> str:
    name = re.sub(r"[\[,;{}()\n\t=€%°]", "", str(name).strip().replace(" ", "_"))
    return re.sub("_+", "_", _ascii(name)).strip("_").lower() or "columna"


def sanitize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(c) for c in df.columns])


def lower_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select(*[_q(c).alias(names.get(c, c)) for c in df.columns])


def cast_schema(df: DataFrame, schema: Mapping[str, str], date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Exactly the schema's columns in its order; absent ones are typed NULLs, unreadable values are NULL."""
    kinds = dict(df.dtypes)

    def one(name: str, kind: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast(kind).alias(name)
        if kind == "date" and kinds[name] == "string":
            return F.try_to_date(_q(name), date_format).alias(name)
        return (_q(name) if kinds[name] == kind else _q(name).try_cast(kind)).alias(name)

    return df.select(*[one(n, k) for n, k in schema.items()])


def select_or_null(df: DataFrame, columns: Iterable[str], kind: str = "string") -> DataFrame:
    return df.select(*[_q(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c in columns])


def coalesce_dual_columns(df: DataFrame, columns: Iterable[str], fallback: Mapping[str, str | None]) -> DataFrame:
    """First-language column, else its second-language twin, else NULL."""
    have = set(df.columns)

    def one(name: str) -> Column:
        found = [_q(x) for x in dict.fromkeys((name, fallback.get(name))) if x in have]
        if not found:
            return F.lit(None).cast("string").alias(name)
        return (F.coalesce(*found) if len(found) > 1 else found[0]).alias(name)

    return df.select(*[one(c) for c in columns])


def project_by_rules(df: DataFrame, names: Iterable[str], rules) -> DataFrame:
    """Builds each column with the first rule whose test accepts its name; rules are (test, build) pairs."""
    out = []
    for name in names:
        build = next((b for accepts, b in rules if accepts(name)), _q)
        out.append(build(name).alias(name))
    return df.select(*out)


def case_rule(column: str, name: str, rules: Mapping[str, str] | None) -> Column:
    """SQL template with a `{col}` placeholder; the plain column where no rule is given."""
    template = (rules or {}).get(name)
    return (F.expr(template.replace("{col}", column)) if template else F.col(column)).alias(name)


def add_missing_metadata(df: DataFrame, season, loaded: Column) -> DataFrame:
    have = {c.lower() for c in df.columns}
    extra = {
        "fuente": F.lit("desconocido"),
        "fecha_carga": F.date_format(loaded, "yyyy-MM-dd HH:mm:ss"),
        "temporada": F.lit(str(season)),
    }
    return df.select("*", *[v.alias(k) for k, v in extra.items() if k not in have])


def complex_to_json(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.to_json(_q(c)).alias(c) if kind.startswith(("array", "struct", "map")) else _q(c) for c, kind in df.dtypes
    ])


def project_excluding(df: DataFrame, excluded: Iterable[str]) -> DataFrame:
    drop = set(excluded)
    return df.select(*[_q(c) for c in df.columns if c not in drop])


def add_control_columns(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return df.select("*", now.cast("timestamp").alias("fecha_carga"),
                     F.date_format(now, "yyyyMMdd").cast("int").alias("periododia"))


def select_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[_q(c) for c in columns if c in df.columns])


RATIO_MARKS = ("porc", "ratio", "ppp")


def clean_values(df: DataFrame) -> DataFrame:
    """Trims everything; text columns are also lowered, unaccented and space-collapsed; blank words become NULL."""
    def one(name: str) -> Column:
        low = name.lower()
        value = F.trim(_q(name)) if "fecha" in low else text.collapse_spaces(text.norm_name(_q(name)))
        if "fecha" not in low and any(mark in low for mark in RATIO_MARKS):
            value = text.strip_percent(value)
        return F.when(~value.isin(fixed.CURATION_BLANKS), value).alias(name)

    return df.select(*[one(c) for c in df.columns])


def clean_catalog_values(df: DataFrame) -> DataFrame:
    """The same for manual catalogues, where dates are also turned to ISO form."""
    def one(name: str) -> Column:
        value = text.norm_name(_q(name))
        value = iso_date(value) if "fecha" in name.lower() else value
        return F.when(~value.isin(fixed.CURATION_BLANKS), value).alias(name)

    return df.select(*[one(c) for c in df.columns])


def zero_fill_by_type(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    whole = [c for c, k in schema.items() if k in ("int", "integer", "bigint", "smallint") and c in df.columns]
    real = [c for c, k in schema.items() if k.startswith(("double", "float", "decimal")) and c in df.columns]
    return df.na.fill(0, subset=whole).na.fill(0.0, subset=real)


MONEY_MARKS = ("valor", "precio", "mercado", "total", "medio")


def normalize_money_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rewrites money text as plain numbers in the named columns, by default those whose name speaks of money."""
    kinds = dict(df.dtypes)
    chosen = set(columns) if columns is not None else {
        c for c, k in kinds.items() if k == "string" and any(m in c.lower() for m in MONEY_MARKS)}
    return df.select(*[text.money_text(_q(c)).alias(c) if c in chosen else _q(c) for c in df.columns])
