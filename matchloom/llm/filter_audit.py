"""Interaction of document filters, kept up to date by an incremental stream that takes back what later files change.

All files of a folder are processed as available-now micro-batches. Four filters judge a text alone; the fifth, "identical to
the text of a smaller id", can change for a document already counted. So the state of a text (its hash is the key) holds the
smallest id seen and the counter cells of the rows with that id; when a smaller id arrives, those rows are taken out of their
cells and put into the cells of the mask with the fifth bit. The state is a table with a part for each micro-batch: a text's
last state is the one with the smallest id, as that only falls. Each part also holds the changes of the counters of (part,
mask, good, toxic); everything about the orders of the filters follows from these few cells.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import common as C

LETTERS = "ABCDE"
COPY = 16
SIGNS = b"#$%&*|"
UPPER = bytes(range(65, 91))
JUDGED = "doc_id long, part string, key binary, mask int"
COMBINED = "key binary, part string, mask int, good int, toxic int, known boolean, least long, n_least long, n long"
CELL = "array<struct<part:string,mask:int,good:int,toxic:int,n:long>>"
STATE = f"key binary, least long, held {CELL}, changes {CELL}"


def text_mask(text: str) -> int:
    """Bits of the filters that a text fails: 1 under 50 words, 2 under 65 % distinct words, 4 over 5 % capitals, 8 signs."""
    data = C.encoded(text)
    ws = data.split()
    capitals = len(data) - len(data.translate(None, UPPER))
    signs = len(data) != len(data.translate(None, SIGNS))
    return (len(ws) < 50) | (100 * len(set(ws)) < 65 * len(ws)) << 1 | (100 * capitals > 5 * len(text)) << 2 | signs << 3


def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [t or "" for t in b["text"].to_pylist()]
        keys = [hashlib.sha256(C.encoded(t)).digest()[:16] for t in texts]
        yield pa.record_batch([b["doc_id"], b["part"], pa.array(keys, pa.binary()), pa.array([text_mask(t) for t in texts], pa.int32())], ["doc_id", "part", "key", "mask"])


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one text and cell as one, in each batch: the smallest id, the rows that have it, and all rows."""
    for b in batches:
        cells: dict[tuple, list[int]] = {}
        for key, part, mask, good, toxic, i in zip(*(b[c].to_pylist() for c in ("key", "part", "mask", "good", "toxic", "doc_id")), strict=True):
            cell = cells.setdefault((key, part, mask, good, toxic, i is not None), [i or 0, 0, 0])
            if i is not None and i < cell[0]:
                cell[0], cell[1] = i, 0
            cell[1] += (i or 0) == cell[0]
            cell[2] += 1
        rows = [(*k, *v) for k, v in cells.items()]
        names = ["key", "part", "mask", "good", "toxic", "known", "least", "n_least", "n"]
        types = [pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def fresh_texts(rows: DataFrame) -> DataFrame:
    """(key, least, cells) of the new rows: a cell's smallest id, its rows with that id, and all its rows. Sums are formed before
    each shuffle, so a text that a third of all rows repeat is a few rows for each task; the list is bounded by the parts."""
    cell = ["key", "part", "mask", "good", "toxic", "known"]
    same = rows.groupBy(*cell, "least").agg(F.sum("n_least").alias("n_least"), F.sum("n").alias("n"))
    cells = same.groupBy(*cell).agg(F.min_by("n_least", "least").alias("n_least"), F.min("least").alias("least"), F.sum("n").alias("n"))
    return cells.groupBy("key").agg(F.min(F.expr("if(known, least, null)")).alias("least"), F.collect_list(F.struct("part", "mask", "good", "toxic", "known", "least", "n_least", "n")).alias("cells"))


def settled(fresh: DataFrame, state: DataFrame) -> DataFrame:
    """The next part of the state from the new rows of each text and what the state holds for it."""
    old = state.where("least is not null").groupBy("key").agg(F.min_by("held", "least").alias("old_held"), F.min("least").alias("old_least"))
    both = fresh.join(old, "key", "left").withColumn("now", F.least("least", "old_least"))
    both = both.withColumn("cells", F.expr("transform(cells, c -> named_struct('part', c.part, 'mask', c.mask, 'good', c.good, 'toxic', c.toxic, 'known', c.known, 'n', c.n, 'first', if(not c.known, c.n, if(c.least = now, c.n_least, 0L))))"))
    one = "named_struct('part', {c}.part, 'mask', {c}.mask{bit}, 'good', {c}.good, 'toxic', {c}.toxic, 'n', {n})"
    added = f"flatten(transform(cells, c -> array({one.format(c='c', bit='', n='c.first')}, {one.format(c='c', bit=f' | {COPY}', n='c.n - c.first')})))"
    back = f"if(least < old_least, flatten(transform(old_held, h -> array({one.format(c='h', bit='', n='-h.n')}, {one.format(c='h', bit=f' | {COPY}', n='h.n')}))), array())"
    firsts = f"transform(filter(cells, c -> c.known and c.first > 0), c -> {one.format(c='c', bit='', n='c.first')})"
    held = f"case when least < old_least or old_least is null then {firsts} when least = old_least then concat(old_held, {firsts}) end"
    return both.select("key", F.expr("if(least <= old_least or old_least is null, least, null)").alias("least"), F.expr(held).alias("held"), F.expr(f"filter(concat({added}, {back}), x -> x.n <> 0)").alias("changes"))


def folder(spark: SparkSession, path: str) -> tuple[str, int]:
    """The path as a stream reads it (a single file must be named by a pattern), and its bytes."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return f"{path[:-1]}[{path[-1]}]" if fs.getFileStatus(at).isFile() else path, fs.getContentSummary(at).getLength()


def counters(spark: SparkSession, path: str, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", batch_bytes: int | None = None, home: str | None = None) -> DataFrame:
    """(part, mask, good, toxic, n): how many rows of all files under `path` fail just the filters of the mask.

    Runs the stream to its end. A micro-batch takes `batch_bytes` of files (by default a sixteenth of all, 128 MB at least) and
    writes one part of the state, which it replaces if it runs again. With a folder `home` a later call reads only files that
    are new since; without, everything is read."""
    home = home or scratch_dir(spark)
    parts = f"{home}/state"
    good = F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good")
    toxic = F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic")
    marks = C.stored(labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("marked")).agg(good, toxic))
    source, size = folder(spark, path)
    size = batch_bytes or max(128 << 20, size // 16)
    docs = spark.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", size).parquet(source)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("string").alias("text"))

    def state(below: str) -> DataFrame:
        return spark.read.schema(f"{STATE}, batch long").parquet(parts).where(below)

    def add(batch: DataFrame, number: int) -> None:
        marked = batch.join(marks, F.col("doc_id") == F.col("marked"), "left").drop("marked").na.fill(0, ["good", "toxic"])
        settled(fresh_texts(marked.mapInArrow(combined, COMBINED)), state(f"batch < {number}")).write.mode("overwrite").parquet(f"{parts}/batch={number}")

    spark.createDataFrame([], STATE).write.mode("overwrite").parquet(f"{parts}/batch=-1")
    docs.mapInArrow(judged, JUDGED).writeStream.foreachBatch(add).option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    changes = state("true").select(F.explode("changes").alias("c")).select("c.*")
    return changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def interactions(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row for each part, order of the filters and step, from (part, mask, good, toxic, n) cells."""
    orders = ["".join(p) for p in itertools.permutations(letters)]
    steps = len(letters)
    held = cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.expr("if(good = 1, n, 0)")).alias("g"), F.sum(F.expr("if(toxic = 1, n, 0)")).alias("t"))
    parts = held.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "g", "t")).alias("cells"))
    listed = parts.select("part", "cells", F.explode(F.sequence(F.lit(0), F.lit(len(orders) * steps - 1))).alias("k"))
    order = F.element_at(F.array(*map(F.lit, orders)), F.floor(F.col("k") / steps).cast("int") + 1)
    listed = listed.select("part", "cells", order.alias("filter_order"), (F.col("k") % steps + 1).cast("int").alias("step"))
    place = f"instr('{letters}', substr(filter_order, %s, 1)) - 1"
    listed = listed.withColumn("bit", F.expr(f"shiftleft(1, {place % 'step'})")).withColumn("prior", F.expr(f"aggregate(sequence(1, 5), 0, (a, i) -> if(i < step, a | shiftleft(1, {place % 'i'}), a))".replace("5", str(steps))))

    def total(what: str, test: str) -> Column:
        return F.expr(f"aggregate(cells, 0L, (a, c) -> a + if({test}, {what}, 0L))")

    removed = "c.mask & bit <> 0 and c.mask & prior = 0"
    return listed.select(
        "part", "filter_order", "step", total("c.n", "c.mask & (prior | bit) = 0").alias("kept"), total("c.n", removed).alias("removed"), total("c.n", "c.mask & bit <> 0 and c.mask & prior <> 0").alias("redundant"),
        total("c.n", "c.mask = bit").alias("unique_fails"), total("c.g", removed).alias("good_lost"), total("c.t", removed).alias("toxic_lost"),
        total(f"c.n * {len(orders)} div bit_count(c.mask)", "c.mask & bit <> 0").alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, **columns) -> DataFrame:
    """Per part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null and empty texts are one text; a null source is the empty part; rows of one id are judged each for itself, and rows
    that are equal in id and text are no copies of each other. A row with a null id is smaller or larger than none: it fails
    no copy test and makes no other row fail. Contradicting labels of one id count as both marks. Extra columns are not read;
    an empty folder gives no rows. A filter is first among the failing ones in equally many orders, which gives `shapley`."""
    return interactions(counters(spark, path, labels, **columns))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
  + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS g, sum(toxic) AS t FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT f1.x || f2.x || f3.x || f4.x || f5.x AS filter_order, [f1.bit, f2.bit, f3.bit, f4.bit, f5.bit] AS bits FROM f f1, f f2, f f3, f f4, f f5 WHERE f1.bit + f2.bit + f3.bit + f4.bit + f5.bit = 31 AND f1.bit | f2.bit | f3.bit | f4.bit | f5.bit = 31),
s AS (SELECT filter_order, CAST(i AS INT) AS step, bits[i] AS bit, CAST(coalesce(list_sum(bits[1:i - 1]), 0) AS INT) AS prior FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
r AS (SELECT part, filter_order, step, bit, CAST(sum(CASE WHEN mask & (prior | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN mask & bit <> 0 AND mask & prior = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & prior <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN mask & bit <> 0 AND mask & prior = 0 THEN g ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN mask & bit <> 0 AND mask & prior = 0 THEN t ELSE 0 END) AS BIGINT) AS toxic_lost FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r
"""
