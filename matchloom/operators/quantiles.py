"""Exact order statistics in bounded memory: the range that holds a rank is narrowed with histograms of fixed size."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

CELLS = 4096


def values_at(values: DataFrame, col: str, ranks: Sequence[int]) -> dict[int, float]:
    """The values at the given places (from 0) of the ascending order of a column of finite doubles without NULL.

    A pass counts the rows of 4096 equal cells between two values, with the least and the greatest value of each. A cell that
    holds a wanted rank and more than one value is cut up in the next pass, between its own least and greatest values; so
    every pass parts values, and a few are enough. No more than 4096 rows reach the driver."""
    found: dict[int, float] = {}
    low, high = values.agg(F.min(col), F.max(col)).first()
    pending = [(low, high, 0, sorted(set(ranks)))] if low is not None else []
    while pending:
        low, high, before, wanted = pending.pop()
        if low == high:
            found |= dict.fromkeys(wanted, low)
            continue
        # Halves, so that the width of the widest range of doubles is a double.
        place = (F.col(col) / 2 - low / 2) / (high / 2 - low / 2) * CELLS
        cell = F.least(F.floor(place), F.lit(CELLS - 1)) if high / 2 - low / 2 > 0 else (F.col(col) > low).cast("long")
        inside = values.where((F.col(col) >= low) & (F.col(col) <= high))
        cells = inside.groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect()
        for r in sorted(cells, key=lambda r: r["c"]):
            here = [k for k in wanted if before <= k < before + r["n"]]
            if here:
                pending.append((r["lo"], r["hi"], before, here))
            before += r["n"]
    return found


def exact_quantile(df: DataFrame, col: str, p: float = 0.5) -> float | None:
    """The p-quantile of a numeric column, between two values in proportion; None without values. NULL and NaN do not count.

    The values are stored once, eight bytes a row, and read some three times. Infinite values stand before and after all."""
    values = stored(df.select(F.col(col).cast("double").alias("v")).where("v is not null and not isnan(v)"))
    n, below = values.agg(F.count(F.lit(1)), F.count_if(F.col("v") == -math.inf)).first()
    if not n:
        return None
    finite = values.where((F.col("v") > -math.inf) & (F.col("v") < math.inf))
    size = n - below - values.where(F.col("v") == math.inf).count()
    at = (n - 1) * p
    ends = {math.floor(at), math.ceil(at)}
    inner = values_at(finite, "v", [k - below for k in ends if below <= k < below + size])
    value = {k: -math.inf if k < below else math.inf if k >= below + size else inner[k - below] for k in ends}
    low, high = value[math.floor(at)], value[math.ceil(at)]
    return low if low == high else low * (math.ceil(at) - at) + high * (at - math.floor(at))
