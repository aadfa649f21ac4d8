"""Filter audit and document fingerprints against plain Python, on small tables with nulls, ties, repeated rows and clashing columns."""

import base64
import collections
import hashlib
import itertools
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from matchloom.llm import document_digest, filter_audit

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, part long, cut int, own int, h int, marked long, good int, least int, batch string"


def rows(n=90, seed=4):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgßéñ") for _ in range(rnd.randint(1, 7)))
    texts = [None, "", "  \t\n", "one", "AB CD EF gh", "x " * 300, "a & b", "Ünïcode one word\x1cstill"]
    for i in range(n):
        texts.append(" ".join(word() for _ in range(rnd.choice([3, 20, 60, 150]))) + rnd.choice(["", "", "#", " ABCDEFGH" * 3]))
    texts += [texts[10], texts[20], "", None, "é" * 900, " ".join(word() for _ in range(3000))] + [texts[11]] * 40
    rnd.shuffle(texts)
    out = [(1000 - 3 * i, t, "en", rnd.choice(["a", "b", None, "é"]), 0, "k", 1, 2, 3, 4, 5, 6, 7, "b") for i, t in enumerate(texts)]
    return out + [out[5], out[5], (out[7][0], "another text", *out[7][2:]), (None, texts[10], *out[7][2:]), (None, None, *out[8][2:])]


LABELS = [(i, i % 3 % 2, int(i % 7 == 0)) for i in range(600, 1001, 2)] + [(1000, 1, 1), (None, 1, 1)]


def mask(t):
    ws = t.encode().split()
    return (len(ws) < 50) + 2 * (100 * len(set(ws)) < 65 * len(ws)) + 4 * (100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t)) + 8 * any(c in "#$%&*|" for c in t)


def audited(data, labels):
    least, good, toxic = {}, collections.Counter(), collections.Counter()
    for r in data:
        if r[0] is not None:
            least[r[1] or ""] = min(least.get(r[1] or "", r[0]), r[0])
    for i, q, x in labels:
        if i is not None:
            good[i], toxic[i] = max(good[i], q == 1), max(toxic[i], x == 1)
    docs = collections.defaultdict(list)
    for r in data:
        t = r[1] or ""
        docs[r[3] or ""].append((mask(t) + 16 * (r[0] is not None and r[0] > least[t]), int(good[r[0]]) if r[0] is not None else 0, int(toxic[r[0]]) if r[0] is not None else 0))
    out, shapley = {}, collections.Counter()
    for part, ds in docs.items():
        for order in itertools.permutations("ABCDE"):
            left = ds
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone = [d for d in left if d[0] & bit]
                left = [d for d in left if not d[0] & bit]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(bool(d[0] & bit) for d in ds) - len(gone), sum(d[0] == bit for d in ds), sum(d[1] for d in gone), sum(d[2] for d in gone)]
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_filter_audit(spark, folder):
    data = rows()
    spark.createDataFrame(data, SCHEMA).repartition(7).write.parquet(f"{folder}/docs")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    want = audited(data, LABELS)
    for size in (1, None):  # a micro-batch for each file, and one for all
        got = filter_audit.audit(spark, f"{folder}/docs", labels, batch_bytes=size)
        assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == want
    assert sum(r[4] for r in want) > 1000
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/none")
    assert filter_audit.audit(spark, f"{folder}/none", labels).count() == 0


def test_filter_audit_takes_back(spark, folder):
    """A later call with the same home reads only new files; smaller ids take the place of those counted before."""
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    data = sorted(rows(), key=lambda r: -(r[0] or 0))
    seen = []
    for at in range(0, len(data), 45):
        spark.createDataFrame(data[at : at + 45], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/docs")
        seen += data[at : at + 45]
        got = filter_audit.audit(spark, f"{folder}/docs", labels, home=f"{folder}/home")
        assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == audited(seen, LABELS)


def plain_features(data, width, rank):
    """Places by definition: every run of `width` windows gives a point to its best ranked window."""
    def level(w):
        return round(1000 * (1 - sum(c * math.log2(c) for c in collections.Counter(w).values()) / (width * math.log2(width))))

    keys = [(rank[level(data[i : i + width])], i) for i in range(len(data) - width + 1)]
    points = collections.Counter()
    for s in range(1 - width, len(keys)):
        if run := keys[max(0, s) : max(0, s + width)]:
            points[min(run)[1]] += 1
    return sorted(i for i, n in points.items() if n >= width // 4)


def plain_print(text, ranks):
    data, width = text.encode(), document_digest.width_of(text)
    at = plain_features(data, width, ranks[width])
    x = np.frombuffer(data, np.uint8)
    seen = list(dict.fromkeys(document_digest.window_hashes(x, np.array(at, int), width).tolist())) if at else []
    if not seen and data:
        seen = [document_digest.xxhash.xxh3_64_intdigest(data)]
    filters = [bytearray(128) for _ in range(-(-len(seen) // 80))]
    for k, h in enumerate(seen):
        for j in range(4):
            bit = (h >> 16 * j) % 1024
            filters[k // 80][bit // 8] |= 1 << bit % 8
    return f"{width}:{len(seen)}:{base64.b64encode(b''.join(filters)).decode()}"


def plain_ranks(data):
    counts = {w: collections.Counter() for w in document_digest.WIDTHS}
    for r in data:
        d, w = (r[1] or "").encode(), document_digest.width_of(r[1] or "")
        for i in range(len(d) - w + 1):
            counts[w][round(1000 * (1 - sum(c * math.log2(c) for c in collections.Counter(d[i : i + w]).values()) / (w * math.log2(w))))] += 1
    return {w: document_digest.rank_table([c[v] for v in range(document_digest.LEVELS)]) for w, c in counts.items()}


def test_document_digest(spark):
    data = rows()
    got = [tuple(r) for r in document_digest.digests(spark.createDataFrame(data, SCHEMA).repartition(6)).collect()]
    ranks = plain_ranks(data)
    key = lambda r: (r[0] is not None, r[0] or 0, document_digest.xxhash.xxh3_64_intdigest((r[1] or "").encode()) >> 1)
    order = sorted({key(r): r[1] or "" for r in data}.items())
    want = []
    for k, (_, text) in enumerate(order):
        m, following = len(text) // 4, order[(k + 1) % len(order)][1]
        new = text[: len(text) - m] + following[:m]
        a, b, c = (plain_print(t, ranks) for t in (text, new, following))
        P = document_digest.Print.read
        line = (order[k][0][1] if order[k][0][0] else None, len(text), hashlib.sha256(new.encode()).hexdigest(), a, b, document_digest.likeness(P(a), P(b)), document_digest.likeness(P(a), P(c)))
        want += [line] * sum(key(r) == order[k][0] for r in data)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert np.mean([w[5] for w in want if w[1] > 100]) > 0.6 and np.mean([w[6] for w in want if w[1] > 100]) < 0.4
    empty = spark.createDataFrame([], SCHEMA)
    assert document_digest.digests(empty).count() == 0
    one = document_digest.digests(spark.createDataFrame([(5, "the same text again " * 40, *data[0][2:])] * 30, SCHEMA)).collect()
    assert len(one) == 30 and {r["near_next"] for r in one} == {1.0}


def test_long_texts_in_pieces(monkeypatch):
    rnd = np.random.default_rng(2)
    x = rnd.integers(97, 105, 5000).astype(np.uint8)
    rank = rnd.permutation(document_digest.LEVELS).astype(np.int32)
    levels = document_digest.windows_of([x.tobytes()], 32)[2]
    whole = document_digest.feature_places(levels, np.array([0, 5000]), rank, 32)
    assert whole.tolist() == plain_features(x.tobytes(), 32, rank)
    monkeypatch.setattr(document_digest, "LONG", 700)
    monkeypatch.setattr(document_digest, "BLOCK", 512)
    assert document_digest.feature_places(document_digest.windows_of([x.tobytes()], 32)[2], np.array([0, 5000]), rank, 32).tolist() == whole.tolist()


def test_hot_ranges(spark):
    """A key with a third of all rows is dealt out to several ranges; each range gets the row that follows it."""
    data = [(7, 1)] * 4000 + [(i, 0) for i in range(8000)]
    keys = spark.createDataFrame(data, "doc_id long, h long").selectExpr("true as has_id", "doc_id", "h").repartition(8)
    bounds, ahead = document_digest.ranges(keys, 30)
    assert 5 < sum(b == (True, 7, 1) for b in bounds) < 15
    order = sorted({(True, *d) for d in data})
    for k, a in enumerate(ahead[:-1]):
        assert a == (order[order.index(bounds[k]) + 1] if k and bounds[k - 1] == bounds[k] else bounds[k])
    assert ahead[-1] == order[0]


def test_audit_sql(spark, folder):
    data = [r for r in rows() if r[0] is not None]
    spark.createDataFrame(data, SCHEMA).coalesce(2).write.parquet(f"{folder}/docs")
    db = duckdb.connect()
    db.register("documents", pa.table({"doc_id": [r[0] for r in data], "text": [r[1] for r in data], "source": [r[3] for r in data]}))
    marks = [r for r in LABELS if r[0] is not None]
    db.register("labels", pa.table({"doc_id": [r[0] for r in marks], "quality": [r[1] for r in marks], "toxic": [r[2] for r in marks]}))
    assert sorted(db.sql(f"SELECT {', '.join(COLUMNS)} FROM ({filter_audit.SQL})").fetchall()) == audited(data, marks)
    assert pytest.approx(120 * 2) == sum(r[3] for r in db.sql(f"SELECT part, filter_order, step, 1 FROM ({filter_audit.SQL}) WHERE step = 1 AND part IN ('a', 'b')").fetchall())
