"""Football measures as column expressions."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import ColumnLike, _c


def per90(c: ColumnLike, minutes: ColumnLike, sign: int = 1) -> Column:
    rate = F.when(_c(minutes) > 0, _c(c) / _c(minutes) * 90).otherwise(F.lit(0.0))
    return rate if sign > 0 else -rate


def minutes_per_goal(minutes: ColumnLike, goals: ColumnLike) -> Column:
    return F.when(_c(goals) > 0, (_c(minutes) / _c(goals)).cast("int")).otherwise(F.lit(0))


def goal_diff(scored: ColumnLike, conceded: ColumnLike) -> Column:
    return (_c(scored) - _c(conceded)).cast("int")


def points_or_computed(points: ColumnLike, won: ColumnLike, drawn: ColumnLike) -> Column:
    return F.coalesce(F.nullif(_c(points), F.lit(0)), _c(won) * 3 + _c(drawn))


def games_or_computed(games: ColumnLike, won: ColumnLike, drawn: ColumnLike, lost: ColumnLike) -> Column:
    return F.coalesce(F.nullif(_c(games), F.lit(0)), _c(won) + _c(drawn) + _c(lost))


def ratio4(a: ColumnLike, b: ColumnLike) -> Column:
    return F.when(_c(b) > 0, F.round(_c(a) / _c(b), 4))


def safe_ratio(num: ColumnLike, den: ColumnLike, scale: float = 1.0, digits: int = 2) -> Column:
    """round(num * scale / den), NULL when the denominator is zero."""
    return F.round(F.try_divide(_c(num) * F.lit(scale), _c(den)), digits)


def count_when(cond: Column) -> Column:
    return F.count_if(cond)


def avg_round(c: ColumnLike, digits: int) -> Column:
    return F.round(F.avg(_c(c)), digits)


def n_distinct(c: ColumnLike) -> Column:
    return F.count_distinct(_c(c))


def result_code(scored: ColumnLike, conceded: ColumnLike, score: ColumnLike) -> Column:
    return (
        F.when(_c(score) == fixed.NO_INFO, F.lit("S/A"))
        .when(_c(scored) > _c(conceded), F.lit("G"))
        .when(_c(scored) == _c(conceded), F.lit("E"))
        .otherwise(F.lit("P"))
    )


def match_status(score: ColumnLike) -> Column:
    return F.when(_c(score) == fixed.NO_INFO, F.lit("Sin jugar/Aplazado")).otherwise(F.lit("Disputado"))


def score_missing(score: ColumnLike) -> Column:
    return F.when(_c(score) == fixed.NO_INFO, F.lit(1)).otherwise(F.lit(0))


def goal_pace_bonus(minutes_per_goal_col: ColumnLike, steps: tuple[float, float, float]) -> Column:
    pace = _c(minutes_per_goal_col)
    return (
        F.when((pace > 0) & (pace <= 90), F.lit(float(steps[0])))
        .when((pace > 90) & (pace <= 130), F.lit(float(steps[1])))
        .when((pace > 130) & (pace <= 180), F.lit(float(steps[2])))
        .otherwise(F.lit(0.0))
    )


def xi_score(position: ColumnLike, weights: Mapping[str, Mapping] = fixed.XI_WEIGHTS) -> Column:
    """Weighted sum of a player's season statistics; the weights depend on the eleven code."""
    branches = None
    for code, table in weights.items():
        total = F.col("minutos_jugados") / F.lit(float(table["min_div"]))
        for stat, weight in table.items():
            if stat != "min_div":
                total = total + F.col(stat) * F.lit(float(weight))
        if code in fixed.XI_GOAL_PACE_BONUS:
            total = total + goal_pace_bonus("min_por_gol", fixed.XI_GOAL_PACE_BONUS[code])
        hit = _c(position) == code
        branches = F.when(hit, total) if branches is None else branches.when(hit, total)
    return branches.otherwise(F.lit(0.0))


def scale_to_cap(c: ColumnLike, cap: float) -> Column:
    return _c(c) / F.lit(float(cap))


def shift_season(c: ColumnLike, years: int = -1) -> Column:
    return _c(c) + F.lit(years)


def to_millions(c: ColumnLike, digits: int = 2) -> Column:
    return F.round(_c(c) / F.lit(1000000), digits)
