"""Corpus pipeline over `documents`: toxicity filter, near-duplicates, repeated passages, source mix, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
`documents`, extra ones included, whatever their names. Null texts count as empty and are kept by the filters; rows with a null
id are never dropped as duplicates. Rows that share an id are documents of their own if their texts differ; of rows equal in id
and text the near-duplicate stage keeps one. Empty tables give empty tables. Ties are settled by id, then by hash of the text.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import minhash_dedup
from matchloom.llm.common import stored
from matchloom.llm.mixing import mix, word_count
from matchloom.llm.packing import pack
from matchloom.llm.phrase_dedup import remove_repeats
from matchloom.llm.queries import ship
from matchloom.llm.toxicity import fit, score_column
from matchloom.operators import ranges

# The stage links from 0.80 on; 0.85 is the contract of op6 alone.
near_documents = partial(minhash_dedup.near_documents, share=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below a half; empty texts have the score of a text without hits. Of contradicting labels
    the toxic one counts."""
    ship(spark)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(score_column(F.col("text"), model) < 0.5)


def whole_rows(docs: DataFrame) -> DataFrame:
    """Each row as one column, so that no column of a stage can clash with one of the table."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def own_ids(docs: DataFrame) -> DataFrame:
    """(row, node, copies): the row, an id that only rows of one id and text share, and how many such rows there are.

    The id is the document's, but texts that share one get ids of their own below all others. Only ids that occur more than
    once take part in the join; a join of nothing costs nothing."""
    rows = whole_rows(docs).withColumn("h", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    keys = rows.select(F.col("row.doc_id").cast("long").alias("i"), "h").where("i is not null")
    seen = stored(keys.groupBy("i", "h").agg(F.count(F.lit(1)).alias("copies")))
    many = stored(seen.groupBy("i").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("texts")).where("n > 1"))
    least = seen.agg(F.min("i")).first()[0] or 0
    pairs = seen.join(many.select(F.col("i").alias("j"), "texts"), F.col("i") == F.col("j")).select("i", "h", "copies", "texts")
    alone = pairs.where("texts = 1").select("i", "h", "copies", F.col("i").alias("own"))
    apart = ranges.running(pairs.where("texts > 1").select("i", "h", "copies"), [], F.struct("i", "h"), {"own": F.lit(1).cast("long")})
    named = stored(alone.unionByName(apart.withColumn("own", F.lit(least) - F.col("own")))).withColumnsRenamed({"i": "ni", "h": "nh"})
    joined = rows.join(named, (F.col("row.doc_id") == F.col("ni")) & (F.col("h") == F.col("nh")), "left")
    return joined.select("row", F.coalesce("own", F.col("row.doc_id").cast("long")).alias("node"), F.coalesce("copies", F.lit(1)).alias("copies"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates (similarity 0.80 and more): that of the smallest id, where texts that
    share an id come first. Of rows equal in id and text one stays; a text is never lost for another text of its id."""
    ship(spark)
    rows = own_ids(docs)
    gone = stored(near_documents(rows.select(F.col("node").alias("doc_id"), F.col("row.text").alias("text"))).where(~F.col("kept")).select(F.col("doc_id").alias("lost")).distinct())
    left = rows.join(gone, F.col("node") == F.col("lost"), "left_anti")
    once = left.where("copies > 1").groupBy("node").agg(F.first("row").alias("row")).select("row")
    return left.where("copies = 1").select("row").unionByName(once).select("row.*")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 20 words and more that start earlier, in another document or the same one; untouched
    texts keep their white space, others have single spaces. Texts without words stay as they are."""
    ship(spark)
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = remove_repeats(docs, carry=others)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    out = out.select("doc_id", text.alias("text"), *[F.col(f"carry_{k}").alias(c) for k, c in enumerate(others)])
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; documents without words are not taken. Rows equal in id, source and number of
    words follow the one taken most often."""
    same = ("doc_id", "source", "size")
    times = stored(mix(docs).groupBy(*same).agg(F.max("times").alias("times")).where("times > 0").select(*[F.col(c).alias(f"m_{c}") for c in same], "times"))
    size = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), word_count("text").alias("size"))
    joined = size.join(times, F.col("row.doc_id").eqNullSafe(F.col("m_doc_id")) & F.col("row.source").eqNullSafe(F.col("m_source")) & (F.col("size") == F.col("m_size")))
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents, or their pieces, in token sequences of at most 2048 ids; each repeat is packed for itself."""
    ship(spark)
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, out, sf_dir)
        if k + 1 < len(STAGES):
            out = stored(out)
    return out
