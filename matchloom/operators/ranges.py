"""Work along an order, cut into ranges that many tasks share, whatever the groups' sizes.

Rows get a range number from stored bounds and move once, to the partition of that number. What a range has to know of the
ranges before it is one small summary each: its first group, its last group and the running values at its end. Only the first
group of a range can have begun earlier, so the summaries, carried from range to range, give one correction per range.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

SAMPLED = 24
FOLDS = {"sum": F.sum, "bit_xor": F.bit_xor}


def with_range(df: DataFrame, bounds: Column, splits: int) -> DataFrame:
    """Column `_cut`: how many of the sorted bounds lie at or before the key `_k`; absent bounds lie after every key.

    Found by halving steps, one projection each, which compile to plain code however many ranges there are."""
    out = df.withColumn("_bounds", bounds).withColumn("_cut", F.lit(0))
    for step in (1 << k for k in reversed(range(max(1, splits - 1).bit_length()))):
        out = out.withColumn("_cut", F.when(F.get("_bounds", F.col("_cut") + (step - 1)) <= F.col("_k"), F.col("_cut") + step).otherwise(F.col("_cut")))
    return out.drop("_bounds")


def placed(keyed: DataFrame, splits: int | None = None) -> tuple[DataFrame, int]:
    """Rows with `_cut`, the range of their column `_k`, each range in the partition of its number; and the number of ranges.

    The bounds are every 24th of a sample of 24 rows a range, chosen by hash: they decide how the work is cut, not what comes
    out. They are found and stored at once; the rows are read again when the result is. There are as many ranges as the
    session has shuffle partitions, 16 at least; rows that do not fill the sample are one range. Equal keys share a range."""
    if splits is None:
        splits = max(16, int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sample = keyed.select("_k").orderBy(F.xxhash64("_k"), "_k").limit(splits * SAMPLED)
    sample = stored(sample.agg(F.sort_array(F.collect_list("_k")).alias("s"), F.count(F.lit(1)).alias("n")))
    if sample.first()["n"] < splits * SAMPLED:
        return keyed.withColumn("_cut", F.lit(0)), 1
    bounds = sample.select(F.filter("s", lambda _, i: ((i + 1) % SAMPLED == 0) & (i + 1 < splits * SAMPLED)).alias("b")).scalar()
    return with_range(keyed, bounds, splits).repartitionById(splits, F.col("_cut")), splits


def _group(part: Sequence[str]) -> Column:
    return F.struct(*[F.col(p) for p in part]) if part else F.struct(F.lit(0).alias("none"))


def carried(rows: DataFrame, part: Sequence[str], at: str, folds: Mapping[str, str]) -> DataFrame:
    """One row per range: `_cut`, its `_first` and `_last` group, and as `_before_<c>` what earlier ranges add to column c of
    the first group (null, if it begins there). `rows` are stored, with `_cut` and running values; `at` numbers a group's rows
    inside the range."""
    ends = rows.groupBy("_cut").agg(F.min(_group(part)).alias("_first"), F.max(_group(part)).alias("_last"),
                                    F.max_by(F.struct(*folds), F.struct(_group(part), F.col(at))).alias("_end"))
    line = Window.orderBy("_cut")
    goes_on = F.col("_first").eqNullSafe(F.lag("_last").over(line)) & F.lag("_cut").over(line).isNotNull()
    ends = ends.withColumn("_goes_on", goes_on).withColumn(
        "_block", F.sum(F.when(F.col("_goes_on") & F.col("_first").eqNullSafe(F.col("_last")), 0).otherwise(1)).over(line))
    upto = Window.partitionBy("_block").orderBy("_cut")
    totals = {c: FOLDS[how](f"_end.{c}").over(upto) for c, how in folds.items()}
    ends = ends.select("*", *[t.alias(f"_upto_{c}") for c, t in totals.items()])
    before = [F.when(F.col("_goes_on"), F.lag(f"_upto_{c}").over(line)).alias(f"_before_{c}") for c in folds]
    return ends.select("_cut", "_first", "_last", "_end", *before)


def with_carry(rows: DataFrame, carry: DataFrame, part: Sequence[str]) -> DataFrame:
    """Rows with the `_before_` values of their range if they are of its first group. The carry has one row per range, so it
    is broadcast."""
    befores = [c for c in carry.columns if c.startswith("_before_")]
    small = carry.where(" or ".join(f"{c} is not null" for c in befores)).select(F.col("_cut").alias("_c"), "_first", *befores)
    return rows.join(F.broadcast(small), (F.col("_cut") == F.col("_c")) & _group(part).eqNullSafe(F.col("_first")), "left").drop("_c", "_first")


def running(df: DataFrame, part: Sequence[str], key: Column, values: Mapping[str, Column], how: Mapping[str, str] | None = None,
            splits: int | None = None) -> DataFrame:
    """Each value added up (or folded by "bit_xor") inside its group up to and including the row, in the order of `key`.

    `key` must be total inside a group. Groups are compared with NULL as a value; without `part` all rows are one group.
    Values are never NULL. The rows are written once, with what each range knows alone; reading them adds what it misses."""
    how = {c: (how or {}).get(c, "sum") for c in values}
    keyed = df.withColumns({f"_v_{c}": v for c, v in values.items()}).withColumn("_k", F.struct(_group(part).alias("g"), key.alias("o")))
    rows, splits = placed(keyed, splits)
    w = Window.partitionBy("_cut", *part).orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select(*df.columns, "_cut", F.row_number().over(Window.partitionBy("_cut", *part).orderBy("_k")).alias("_at"),
                        *[FOLDS[how[c]](f"_v_{c}").over(w).alias(f"_r_{c}") for c in values])
    if splits == 1:
        return local.select(*df.columns, *[F.col(f"_r_{c}").alias(c) for c in values])
    local = stored(local)
    carry = carried(local, part, "_at", {f"_r_{c}": how[c] for c in values})
    out = with_carry(local, carry, part)

    def whole(c: str) -> Column:
        mine, before = F.col(f"_r_{c}"), F.col(f"_before__r_{c}")
        return F.when(before.isNull(), mine).otherwise(mine + before if how[c] == "sum" else mine.bitwiseXOR(before))

    return out.select(*df.columns, *[whole(c).alias(c) for c in values])


def runs(df: DataFrame, part: Sequence[str], key: Column, cond: Column, splits: int | None = None) -> DataFrame:
    """Runs of consecutive rows that satisfy `cond`: per run the groups' columns, number of its first (`desde`) and last row
    (`hasta`) in the group, and its length (`racha`). A NULL condition counts as not satisfied.

    Ranges find their own runs in one pass. Only runs that touch a range's end can belong together; these are at most two a
    range, and adjoining ones are merged by their numbers."""
    keyed = df.select(*part, F.coalesce(cond, F.lit(False)).alias("_hit"), F.struct(_group(part).alias("g"), key.alias("o")).alias("_k"))
    rows, splits = placed(keyed, splits)
    w = Window.partitionBy("_cut", *part).orderBy("_k")
    rows = rows.withColumn("_at", F.row_number().over(w)).withColumn(
        "_hits", F.sum(F.col("_hit").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = F.when(F.col("_hit"), F.col("_at") - F.col("_hits")).alias("_run")
    local = rows.groupBy("_cut", *part, run).agg(F.min("_at").cast("long").alias("desde"), F.max("_at").cast("long").alias("hasta"),
                                                 F.count(F.lit(1)).alias("racha"))
    if splits == 1:
        return local.where("_run is not null").select(*part, F.col("desde").cast("int").alias("desde"), F.col("hasta").cast("int").alias("hasta"), "racha")
    local = stored(local)
    carry = carried(local, part, "hasta", {"hasta": "sum"})
    found = with_carry(local.where("_run is not null"), carry, part)
    last = carry.select(F.col("_cut").alias("_c"), "_last", F.col("_end.hasta").alias("_size"))
    found = found.join(F.broadcast(last), F.col("_cut") == F.col("_c"), "left")
    before = F.coalesce("_before_hasta", F.lit(0))
    at_start = (F.col("desde") == 1) & F.col("_before_hasta").isNotNull()
    at_end = _group(part).eqNullSafe(F.col("_last")) & (F.col("hasta") == F.col("_size"))
    found = found.select(*part, (F.col("desde") + before).alias("desde"), (F.col("hasta") + before).alias("hasta"), "racha", (at_start | at_end).alias("_open"))
    line = Window.partitionBy(*part).orderBy("desde")
    opened = found.where("_open").withColumn("_new", F.when(F.col("desde") == F.lag("hasta").over(line) + 1, 0).otherwise(1))
    opened = opened.withColumn("_island", F.sum("_new").over(line)).groupBy(*part, "_island").agg(
        F.min("desde").alias("desde"), F.max("hasta").alias("hasta"), F.sum("racha").alias("racha")).drop("_island")
    out = found.where("not _open").drop("_open").unionByName(opened)
    return out.select(*part, F.col("desde").cast("int").alias("desde"), F.col("hasta").cast("int").alias("hasta"), "racha")
