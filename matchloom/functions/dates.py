"""Date parsing. Every parser gives NULL, never an error, for text it cannot read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import ColumnLike, _c, is_placeholder, literal_map



def _month_number(name: Column, names: list[str]) -> Column:
    numbers = {m: f"{i + 1:02d}" for i, m in enumerate(names)}
    return F.try_element_at(literal_map(numbers), F.lower(name))


def birth_date(c: ColumnLike) -> Column:
    """'10/05/1990 (34)' -> 1990-05-10."""
    return F.try_to_date(F.regexp_extract(_c(c), r"^(\d{2}/\d{2}/\d{4})", 1), "dd/MM/yyyy")


def birth_age(c: ColumnLike) -> Column:
    return F.regexp_extract(_c(c), r"\((\d+)\)", 1).try_cast("int")


def age(c: ColumnLike, as_of: ColumnLike) -> Column:
    return F.floor(F.months_between(_c(as_of), _c(c)) / 12).cast("int")


def english_date(c: ColumnLike, season: ColumnLike) -> Column:
    """'Friday, March 1' or 'Friday, March 1 2024'; the season is the year when none is written."""
    text = _c(c)
    month = _month_number(F.regexp_extract(text, "^[A-Za-z]+, ([A-Za-z]+) ", 1), fixed.ENGLISH_MONTHS)
    day = F.lpad(F.regexp_extract(text, "^[A-Za-z]+, [A-Za-z]+ ([0-9]{1,2})", 1), 2, "0")
    year = F.coalesce(F.nullif(F.regexp_extract(text, "([0-9]{4})$", 1), F.lit("")), _c(season).cast("string"))
    return F.try_to_date(F.concat_ws("-", year, F.coalesce(month, F.lit("00")), day), "yyyy-MM-dd")


def match_date(c: ColumnLike, season: ColumnLike) -> Column:
    parsed = F.coalesce(F.try_to_date(_c(c), "dd-MM-yyyy"), english_date(c, season))
    return F.when(~is_placeholder(c, fixed.TEXT_BLANKS), parsed)


def spanish_date(c: ColumnLike, season: ColumnLike, as_of: ColumnLike) -> Column:
    """Spanish, ISO, dashed and relative dates as 'dd-MM-yyyy' text; unknown forms pass through."""
    text = _c(c)
    lowered = F.lower(text)
    tail = F.trim(F.regexp_extract(text, "([^,]*)$", 1))
    pattern = r"^(\S+)\s+de\s+(\S+)(?:\s+de\s+(\S+))?$"
    day = F.regexp_extract(tail, pattern, 1)
    month = F.coalesce(_month_number(F.regexp_extract(tail, pattern, 2), fixed.SPANISH_MONTHS), F.lit("00"))
    year = F.coalesce(F.nullif(F.regexp_extract(tail, pattern, 3), F.lit("")), _c(season).cast("string"))
    dashed = r"^([^-]+)-([^-]+)-([^-]+)$"
    a, b, d = (F.regexp_extract(text, dashed, i) for i in (1, 2, 3))

    def two(x: Column) -> Column:
        return F.when(F.length(x) < 2, F.lpad(x, 2, "0")).otherwise(x)

    return (
        F.when(lowered == "hoy", F.date_format(_c(as_of), "dd-MM-yyyy"))
        .when(lowered == "mañana", F.date_format(F.date_add(_c(as_of), 1), "dd-MM-yyyy"))
        .when(tail.rlike(pattern), F.concat_ws("-", two(day), month, year))
        .when(text.rlike(dashed) & (F.length(a) == 4), F.concat_ws("-", two(d), two(b), a))
        .when(text.rlike(dashed), F.concat_ws("-", two(a), two(b), d))
        .otherwise(text)
    )


def iso_date(c: ColumnLike) -> Column:
    """Every 'd/M/yyyy' inside the text is turned round to 'yyyy-M-d'."""
    return F.regexp_replace(_c(c), r"(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$2-$1")


def loose_date(c: ColumnLike, default_year: ColumnLike) -> Column:
    """'5/3/24', '05-03-2024' or a Spanish month name as ISO text; other text passes through."""
    text = F.lower(F.trim(_c(c)))
    slashed = r"^(\d{1,2})[-/](\d{1,2})[-/](\d{2,4})"
    d, m, y = (F.regexp_extract(text, slashed, i) for i in (1, 2, 3))
    full_year = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    year = F.coalesce(F.nullif(F.regexp_extract(text, r"(\d{4})", 1), F.lit("")), _c(default_year).cast("string"))
    spoken = F.coalesce(*[
        F.when(text.contains(m_name), F.concat_ws("-", year, F.lit(f"{i + 1:02d}"), F.lit("01")))
        for i, m_name in enumerate(fixed.SPANISH_MONTHS)
    ], F.when(text.contains("setiembre"), F.concat_ws("-", year, F.lit("09"), F.lit("01"))))
    return F.when(
        text.rlike(slashed), F.concat_ws("-", full_year, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    ).otherwise(F.coalesce(spoken, text))


def date_or_null(c: ColumnLike, fmt: str = "dd/MM/yyyy") -> Column:
    return F.when(~is_placeholder(c, fixed.TEXT_BLANKS), F.try_to_date(_c(c), fmt))


def season_of(c: ColumnLike) -> Column:
    return F.year(_c(c))


def day_stamp(c: ColumnLike) -> Column:
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def historical_age(age_now: ColumnLike, loaded: ColumnLike, season: ColumnLike) -> Column:
    return _c(age_now) - (F.year(_c(loaded)) - _c(season))
