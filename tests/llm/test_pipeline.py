"""Stages of the pipeline against plain Python: repeated ids, copies, clashing columns, empty tables."""

import collections

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

CLASHES = "doc_id long, text string, lang string, source string, n_chars long, times int, turn int, mixed_id long, row string, node long, h long, size int, copies int, m_doc_id int, own int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), k, k + 1, 7, "r", 1, 2, 3, 4, 5, 6) for k, (i, t, s) in enumerate(rows)], CLASHES)


def near(a, b):
    sets = [{tuple(w[s : s + 5]) for s in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for t in (a, b)]
    return bool(sets[0] and sets[1]) and 100 * len(sets[0] & sets[1]) >= 80 * len(sets[0] | sets[1])


def text(seed, n=60):
    return " ".join(f"w{seed}x{i * i % 97}" for i in range(n))


def test_repeated_ids_lose_no_text(spark):
    w, z, y = text(1), text(2), text(3)
    rows = [(5, w, "a"), (7, w, "a"), (7, z, "b"), (5, w, "a"), (9, y, None), (9, y, None), (9, y + " end", None), (None, w, "a"), (None, w, "a"), (11, None, "a"), (11, "", "a"), (12, text(4), "c")]
    out = corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows).repartition(3), "")
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted(t or "" for i, t in kept if i is not None) == sorted([w, z, "", text(4), max(k for i, k in kept if i == 9)])
    assert sum(i is None for i, _ in kept) == 2 and out.columns == frame(spark, rows[:1]).columns
    usable = sorted({(i, t) for i, t, _ in rows if i is not None and t}, key=repr)
    for i, t in usable:  # every text is kept or near to a kept one, and no two kept ones are near
        assert any(t == k or near(t, k) for j, k in kept if j is not None)
    texts = [k for j, k in kept if j is not None and k]
    assert not any(near(a, b) for p, a in enumerate(texts) for b in texts[p + 1 :])


def test_mix_keeps_columns(spark):
    rows = [(i, text(i, 20 + i), "abc"[i % 3]) for i in range(30)] + [(3, text(99, 5), "a"), (None, text(98, 7), None), (40, None, "a")]
    docs = frame(spark, rows)
    out = corpus_pipeline.mix_sources(spark, docs, "")
    assert out.columns == docs.columns
    known = {tuple(r) for r in docs.collect()}
    times = collections.Counter(tuple(r) for r in out.collect())
    assert set(times) <= known and max(times.values()) <= 3 and not any(r[1] is None for r in times)
    want = collections.Counter()
    for r in corpus_pipeline.mix(docs).collect():
        want[r["source"]] += r["taken"]
    got = collections.Counter()
    for r, n in times.items():
        got[r[3]] += n * len(r[1].split())
    assert got == want


def test_repeats_keep_columns(spark):
    passage = text(50, 30)
    rows = [(1, "start " + passage, "a"), (2, text(51) + "\n " + passage, "b"), (3, "  keep\tthis ", None), (4, None, "a"), (2, passage, "c")]
    out = corpus_pipeline.drop_repeats(spark, frame(spark, rows), "")
    got = {(r["doc_id"], r["source"]): r for r in out.collect()}
    assert got[1, "a"]["text"] == "start " + passage and got[2, "b"]["text"] == text(51) and got[2, "c"]["text"] == ""
    assert got[3, None]["text"] == "  keep\tthis " and got[4, "a"]["times"] == 3 and len(got) == 5
    assert out.columns == frame(spark, rows).columns


def test_empty_tables(spark, folder):
    empty = frame(spark, [(1, "x", "a")]).limit(0)
    empty.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, folder)
        assert out.count() == 0 and out.columns == empty.columns, name
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_toxic_documents_go_and_all_else_is_packed(spark, folder):
    rows = [(i, text(i, 40) + (" you stupid worthless idiot scum" if i % 4 == 0 else ""), "ab"[i % 2]) for i in range(80)] + [(100, None, "a"), (101, "", None)]
    docs = frame(spark, rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert {r[0] for r in clean.select("doc_id").collect()} == {i for i, _, _ in rows if i % 4 or i >= 100}
    packed = corpus_pipeline.run(spark, folder)
    ids = {r[0] for r in packed.select("doc_id").distinct().collect()}
    assert ids and all(i % 4 and i < 80 for i in ids)
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["n"] == r["end"] <= 2048 for r in full)
