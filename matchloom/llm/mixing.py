"""Mixing of sources to target weights by weighted fair queueing, in DataFrame operations.

Every document gets a place in a shuffled order of its source and a virtual finish time: the source's tokens up to and
including it, over the source's target. In the order of finish times all sources advance in proportion to their targets, so
the prefix that fills the budget is the mix. Running totals are built from sums of small hash ranges, so no task holds a
source, and the cut is found by narrowing a range of finish times with bounded histograms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (5.0, 2.0, 1.0)
RANGE_ROWS = 50_000
CELLS = 4096


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(C.WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, most: float = 3.0) -> DataFrame:
    """(source, source_size, rank, target): the total shared by weight, none above `most` times its size.

    Filled from the lowest size-to-weight ratio upward: a source stops at its bound if its share of what is left would pass
    it, and the others share the excess. One row for each source is all this sees."""
    alphabetical = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
    x = sources.withColumn("rank", F.row_number().over(alphabetical)).withColumn("w", w).withColumn("bound", most * F.col("source_size"))
    order = Window.orderBy(F.col("bound") / F.col("w"), "rank")
    everything = Window.partitionBy(F.lit(1))
    x = x.withColumn("before", F.coalesce(F.sum("bound").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    x = x.withColumn("left", F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    x = x.withColumn("level", (F.sum("source_size").over(everything) - F.col("before")) / F.col("left"))
    x = x.withColumn("level", F.min(F.when(F.col("level") <= F.col("bound") / F.col("w"), F.struct(F.col("bound") / F.col("w"), "rank", "level"))).over(everything)["level"])
    return x.select("source", "source_size", "rank", F.least("bound", F.col("level") * F.col("w")).alias("target"))


def cut_of(turns: DataFrame, budget: int) -> tuple[list, dict | None]:
    """Where the order of finish times passes the budget: narrowed ranges of `v`, and the last turn taken inside the last."""
    lo, hi = 0.0, (turns.agg(F.max("v")).first()[0] or 0.0) * (1 + 1e-9) + 1e-9
    spent, levels, inside = 0, [], turns
    for _ in range(20):
        width = (hi - lo) / CELLS
        cell = F.least(F.floor((F.col("v") - lo) / width), F.lit(CELLS - 1))
        sums = sorted(inside.groupBy(cell.alias("c")).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["c"])
        for r in sums:
            if spent + r["s"] > budget:
                break
            spent += r["s"]
        else:
            return levels, None
        levels.append((lo, width, r["c"]))
        inside = inside.where(cell == r["c"])
        lo, hi = lo + width * r["c"], lo + width * (r["c"] + 1)
        if r["n"] <= RANGE_ROWS or width <= 0:
            break
    order = Window.orderBy("v", "rank", "k", "size", "turn")
    last = inside.withColumn("run", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("run") <= budget - spent)
    row = last.agg(F.max(F.struct("v", "rank", "k", "size", "turn")).alias("m")).first()["m"]
    return levels, row.asDict() if row else {}


def taken_turns(v: Column, turn: Column, levels: list, last: dict | None) -> Column:
    """Whether a turn lies before the cut."""
    if last is None and not levels:
        return F.lit(True)
    before, inside = F.lit(False), F.lit(True)
    for lo, width, c in levels:
        cell = F.least(F.floor((v - lo) / width), F.lit(CELLS - 1))
        before = before | (inside & (cell < c))
        inside = inside & (cell == c)
    if last is None:
        return before | inside
    if not last:
        return before
    return before | (inside & (F.struct(v.alias("v"), F.col("rank"), F.col("k"), F.col("size"), turn.alias("turn")) <= F.struct(*[F.lit(last[c]).cast(t).alias(c) for c, t in (("v", "double"), ("rank", "int"), ("k", "string"), ("size", "long"), ("turn", "int"))])))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, repeats: int = 3) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, times), one row for each input row; taken = size * times.

    The budget is the sum of all sizes. Null and empty texts have size 0 and are taken 0 times; a null source is a source of
    its own, the last; null ids count as an empty id; repeated rows are alike, but each takes its own turn. A source with
    target 0 has no words. Extra columns are not read; an empty table gives no rows. The shuffle is the md5 of the id, so
    reruns agree."""
    rows = C.stored(df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("k")))
    n, budget = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    digits = 2
    while 16**digits * RANGE_ROWS < n:
        digits += 1
    rows = rows.withColumn("range", F.substring("k", 1, digits))
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("s"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("s").alias("source_size")), weights, float(repeats))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("s").over(upto), F.lit(0))).drop("s")
    sums = sums.alias("a").join(targets.alias("b"), F.expr("a.source <=> b.source")).select("a.*", "source_size", "rank", "target")
    joined = rows.alias("r").join(sums.alias("s"), F.expr("r.source <=> s.source and r.range = s.range")).select("r.*", "before", "source_size", "rank", "target")
    within = Window.partitionBy("rank", "range").orderBy("k", "size").rowsBetween(Window.unboundedPreceding, 0)
    timed = C.stored(joined.withColumn("upto", F.col("before") + F.sum("size").over(within)))

    def finish(turn: Column) -> Column:
        return (turn.cast("long") * F.col("source_size") + F.col("upto")) / F.col("target")

    turns = timed.where("size > 0").withColumn("turn", F.explode(F.array(*[F.lit(i) for i in range(repeats)])))
    turns = turns.select("rank", "k", "size", "turn", finish(F.col("turn")).alias("v"))
    levels, last = cut_of(turns, budget or 0)
    times = sum((F.when((F.col("size") > 0) & taken_turns(finish(F.lit(i)), F.lit(i), levels, last), 1).otherwise(0) for i in range(repeats)), F.lit(0))
    return timed.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("times"))


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 3.0::DOUBLE * source_size AS bound FROM r),
f AS (SELECT *, coalesce(sum(bound) OVER (ORDER BY bound / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_, sum(w) OVER (ORDER BY bound / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_,
  CAST(sum(source_size) OVER () AS BIGINT) AS total FROM w),
l AS (SELECT (total - before_) / left_ AS lvl FROM f WHERE (total - before_) / left_ <= bound / w ORDER BY bound / w, rk LIMIT 1),
t AS (SELECT source, source_size, rk, least(bound, (SELECT lvl FROM l) * w) AS target FROM f),
x AS (SELECT d.*, t.source_size, t.rk, t.target, CAST(sum(d.size) OVER (PARTITION BY t.rk ORDER BY d.k, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT doc_id, rk, k, size, i, (i * source_size + upto) / target AS v FROM x, (VALUES (0), (1), (2)) AS n(i) WHERE size > 0),
c AS (SELECT *, sum(size) OVER (ORDER BY v, rk, k, size, i ROWS UNBOUNDED PRECEDING) AS run FROM e),
g AS (SELECT doc_id, k, CAST(sum(size) AS BIGINT) AS taken FROM c WHERE run <= (SELECT max(total) FROM f) GROUP BY doc_id, k)
SELECT x.doc_id, x.size, x.source_size, x.target, coalesce(g.taken, 0) AS taken FROM x LEFT JOIN g ON x.k = g.k
"""
