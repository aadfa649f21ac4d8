"""Registered queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .filter_audit import SQL as AUDIT_SQL
from .metric_search import SQL as SEARCH_SQL
from .mixing import SQL as MIX_SQL
from .url_reputation import SQL as URL_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once a session, so that tasks can import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{os.path.basename(top)}.zip")
    with open(path, "wb") as f:
        f.write(data.getvalue())
    spark.sparkContext.addPyFile(path)
    _SENT.add(app)


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op2_phrase_dedup")
def op2(spark, sf):
    from .phrase_dedup import remove_repeats

    return remove_repeats(table(spark, sf, "documents"), window=20, with_text=False).drop("kept_text")


@query("op8_suffix_dedup")
def op8(spark, sf):
    from .suffix_dedup import remove_repeated_bytes

    return remove_repeated_bytes(table(spark, sf, "documents"), length=400, with_text=False).drop("kept")


@query("op9_packing")
def op9(spark, sf):
    from .packing import pack

    return pack(table(spark, sf, "documents"), limit=2048, end_id=0)


@query("op10_source_mix", MIX_SQL)
def op10(spark, sf):
    from .mixing import mix

    return mix(table(spark, sf, "documents"), weights=(5.0, 2.0, 1.0), repeats=3).drop("source", "times")


@query("op1_toxicity")
def op1(spark, sf):
    from .toxicity import toxicity

    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op5_url_reputation", URL_SQL)
def op5(spark, sf):
    from .url_reputation import filter_urls

    return filter_urls(table(spark, sf, "pages"), table(spark, sf, "labels")).drop("bad_share", "bad_lower")


@query("op7_metric_search", SEARCH_SQL)
def op7(spark, sf):
    from .metric_search import top_k

    return top_k(table(spark, sf, "embeddings"), k=5, every=50)


@query("op3_embedding_dedup")
def op3(spark, sf):
    from .embedding_dedup import near_vectors

    return near_vectors(table(spark, sf, "embeddings"), least=0.9, recall=0.99)


@query("op6_minhash_dedup")
def op6(spark, sf):
    from .minhash_dedup import near_documents

    return near_documents(table(spark, sf, "documents"), share=85)


@query("op4_lattice_lm")
def op4(spark, sf):
    from .lattice_lm import lattice_scores

    return lattice_scores(table(spark, sf, "documents"), folds=7, held_fold=2)


@query("op11_filter_audit", AUDIT_SQL)
def op11(spark, sf):
    from .filter_audit import audit

    return audit(spark, f"{sf}/documents.parquet", table(spark, sf, "labels"))


@query("op13_document_digest")
def op13(spark, sf):
    from .document_digest import digests

    return digests(table(spark, sf, "documents"))


@query("op12_prefix_trie")
def op12(spark, sf):
    from .prefix_trie import trie

    return trie(table(spark, sf, "conversations"), every=100, most=6)
