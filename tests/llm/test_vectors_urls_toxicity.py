"""Vector, URL and toxicity operators and the pipeline on small tables with nulls, ties and clashing columns."""

import collections

import numpy as np
import pytest

from matchloom.llm import embedding_dedup, metric_search, toxicity, url_reputation
from matchloom.llm.common import components

VECTORS = "vec_id long, embedding array<float>, label int, id long, cell int, v string, kind int"


def vectors():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(420, 16))
    x[200:260] = x[0] + 0.15 * rng.normal(size=(60, 16))
    x[260:300] = x[1]
    rows = [(i, [float(c) for c in v], 0, 1, 2, "v", 3) for i, v in enumerate(x)]
    odd = [None, [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [0.0] * 15, []]
    return rows + [(500 + i, v, 0, 1, 2, "v", 3) for i, v in enumerate(odd)] + [(None, rows[5][1], 0, 1, 2, "v", 3)]


def test_recall_with_many_centres(spark):
    """Links of all vectors against brute force, with the codebooks of a table of 200,000 rows (22 centres a half)."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(4000, 48))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.normal(size=(1500, 48))
    away -= (away * base[:1500]).sum(1, keepdims=True) * base[:1500]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cos = rng.uniform(0.9, 1.0, (1500, 1))
    x = np.concatenate([base, cos * base[:1500] + np.sqrt(1 - cos**2) * away])
    index = embedding_dedup.fit(x, 200_000, 0.9, 0.99)
    cells = index.cells(x)
    assert len(index.first) * len(index.second) > 400 and index.visits < len(index.first) * len(index.second)
    seen = index.sequences(x[:1500])
    assert np.mean((seen == cells[4000:, None]).any(1)) > 0.96
    place = index.places(x[:1500], x[4000:])
    inside = place < index.visits
    assert np.array_equal(inside, (seen == cells[4000:, None]).any(1)) and np.array_equal(seen[inside, place[inside]], cells[4000:][inside])
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    true = (x @ x.T >= 0.9).sum(1) - 1
    assert all(got[i] <= n for i, n in enumerate(true)) and sum(got.values()) >= 0.96 * true.sum()


def test_near_vectors(spark):
    df = spark.createDataFrame(vectors(), VECTORS)
    got = embedding_dedup.near_vectors(df).collect()
    good = [(r[0], np.array(r[1], np.float32).astype(float)) for r in vectors() if r[0] is not None and r[0] < 500]
    x = np.stack([v for _, v in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    counts = {i: int(n) - 1 for (i, _), n in zip(good, near.sum(1))}
    out = {r["vec_id"]: r for r in got}
    assert len(got) == len(vectors())
    found = sum(out[i]["n_links"] for i in counts)
    assert 0.9 * sum(counts.values()) <= found <= sum(counts.values())
    assert all(out[i]["n_links"] <= counts[i] for i in counts)
    assert all(out[i]["n_links"] == 0 and out[i]["kept"] for i in (500, 501, 502, 503, 504, 505))
    assert {out[i]["component_id"] for i in range(260, 300)} == {1} and out[1]["kept"] and not out[260]["kept"]
    assert embedding_dedup.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_vectors_whose_squares_leave_the_range_keep_their_rows(spark):
    base = [float(k + 1) for k in range(8)]
    rows = [(k, [c * scale for c in base]) for k, scale in enumerate((1.0, 1e200, 1e-200, -1e200, 1e307 / 8, 1e-160))] + [(6, [0.0] * 8), (7, [5e-324] + [0.0] * 7)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {**dict.fromkeys((0, 1, 2, 4, 5), (4, 0)), 3: (0, 3), 6: (0, 6), 7: (0, 7)}


def test_top_k(spark):
    df = spark.createDataFrame(vectors(), VECTORS)
    q = {r[0]: [int(np.floor(256 * float(np.float32(c)))) for c in r[1]] for r in vectors() if r[0] is not None and r[0] < 500}
    q[505] = [0] * 16
    want = set()
    for i in q:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)[:5]
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    assert {tuple(r) for r in metric_search.top_k(df).collect()} == want
    assert metric_search.top_k(spark.createDataFrame([], VECTORS)).count() == 0
    assert metric_search.top_k(df.where("vec_id in (50, 60)")).count() == 1


def test_components_of_a_path_a_star_and_noise(spark):
    rng = np.random.default_rng(1)
    ids = rng.permutation(200).tolist()
    edges = [(ids[i], ids[i + 1]) for i in range(59)] + [(1000, 1000 + k) for k in range(1, 40)] + [(3000 - k, 3000) for k in range(1, 40)] + [(5, 5), (None, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in ids[:60]} == {min(ids[:60])}
    assert {got[i] for i in range(1000, 1040)} == {1000} and {got[i] for i in range(2961, 3001)} == {2961}
    assert len(got) == 60 + 40 + 40


@pytest.mark.parametrize("n", [80, 800])
def test_components_of_chains_that_meet_at_their_newest_node(spark, n):
    ids = [*range(1, n, 2), *range(n - 2, -1, -2)]
    got = sorted(tuple(r) for r in components(spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")).collect())
    assert got == [(i, 0) for i in range(n)]


def test_urls_and_rules(spark):
    urls = ["http://A.b.example.NET/en/x?q=1#f", "https://example.net/en", "http://net?x", "http://x.net/", "ftp://u.example.com/de/", "http://org/fr/", "http://xorg/fr/", "no scheme", None, "http://", "a://b://c/d", "http://h.co.uk/p"]
    pages = spark.createDataFrame([(i, u, "h", 1, "d") for i, u in enumerate(urls)] + [(3, urls[3], "h", 1, "d"), (None, urls[3], "h", 1, "d")], "page_id long, url string, html string, host int, domain string")
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (11, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_reputation.filter_urls(pages, labels).collect()}
    assert got[0] == ("a.b.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("example.net", "/en", "net/", "block")
    assert got[2][:3] == ("net", "", None) and got[3] == ("x.net", "/", "net/", "block")
    assert got[4][2:] == ("example.com/de/", "block") and got[5][2:] == ("org/fr/", "allow") and got[6][2] is None
    assert got[7][:2] == got[8][:2] == got[9][:2] == ("", "") and got[10][:2] == ("b:", "//c/d")
    assert url_reputation.filter_urls(pages.limit(0), labels).count() == 0
    assert url_reputation.filter_urls(pages, labels.limit(0)).count() == len(urls) + 2


def test_reputation_shrinks_towards_parents(spark):
    rows = [(i, f"http://bad{i % 3}.farm.test/{i}") for i in range(60)] + [(100 + i, f"http://good{i % 5}.site.test/{i}") for i in range(100)] + [(900, "http://new.farm.test/"), (901, "http://new.site.test/"), (902, "http://else.where/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, 0) for i in range(60)] + [(100 + i, 1) for i in range(100)], "doc_id long, quality int")
    got = {r["page_id"]: r for r in url_reputation.filter_urls(pages, labels, rules=()).collect()}
    assert got[0]["verdict"] == "block" and got[100]["verdict"] == "allow"
    assert got[901]["bad_share"] < got[902]["bad_share"] < got[900]["bad_share"] < got[0]["bad_share"] + 1e-9


@pytest.fixture(scope="module")
def toxic_docs(spark):
    rng = np.random.default_rng(9)
    clean = [f"w{k}x" for k in range(200)]
    rows, labels = [], []
    for i in range(400):
        ws = [clean[k] for k in rng.integers(0, 200, rng.integers(20, 200))]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                ws.insert(int(rng.integers(0, len(ws))), ["idiot", "zorgblat", "vermin"][int(rng.integers(0, 3))])
        rows.append((i, " ".join(ws), 1.0, "x"))
        labels.append((i, int(bad)))
    rows += [(1000, "w1x w2x 1d10t w3x \u0456diot w5x zorgb1at", 1.0, "x"), (1001, "", 1.0, "x"), (1002, None, 1.0, "x"), (None, "w1x", 1.0, "x"), (1003, "w1x " * 50_000, 1.0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, y string"), spark.createDataFrame(labels + [(0, 1), (None, 1)], "doc_id long, toxic int")


def test_toxicity(toxic_docs):
    docs, labels = toxic_docs
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    wrong = [i for i in range(400) if got[i]["predicted"] != int(i % 5 == 0)]
    assert len(wrong) <= 4
    assert got[1000]["predicted"] == 1 and got[1001]["predicted"] == got[1002]["predicted"] == got[1003]["predicted"] == 0
    assert got[None]["held_out"] is False and all(0 <= r["score"] <= 1 for r in got.values())
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert {r["predicted"] for r in toxicity.toxicity(docs.where("doc_id in (1, 2, 3)"), labels.limit(0)).collect()} == {0}


def test_exception_phrases_do_not_count():
    model = toxicity.Model({"trash": 2.0})
    machine = model.matcher()
    hits = lambda t: toxicity.weighted_hits(machine, toxicity.fold(t))
    assert hits("a trash can") == 0 and hits("you TR4SH!") == 2.0 and hits("untrash") == 0 and hits("trash, trash bin") == 2.0


def test_symbols_before_digits_and_symbols_are_letters():
    machine = toxicity.Model({toxicity.fold(w): 1.0 for w in toxicity.INSULTS}).matcher()
    hits = lambda t: toxicity.weighted_hits(machine, toxicity.fold(t))
    for t in ("a$$hole", "ba$7ard", "id|0t", "$7up1d", "a$\u200b$hole", "b@$tard", "idiot$", "idiot$ 5", "idiot|"):
        assert hits(t) == 1.0, t
    assert toxicity.fold("$100, a$$ b@") == toxicity.fold(" 100, a   b ")
    assert len(toxicity.fold("|" * 300_000 + "a")) == 300_001


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = collections.OrderedDict()
    out = docs
    from matchloom.llm.common import stored

    for name, stage in corpus_pipeline.STAGES:
        before = out
        out = stored(stage(spark, out, sf))
        counts[name] = out.count()
        if name != "packing":
            assert out.columns == docs.columns
        if name == "minhash_near_dedup":
            again = {r["component_id"] for r in corpus_pipeline.near_documents(before).collect()}
            assert {r["doc_id"] for r in out.select("doc_id").collect()} == again
    assert counts["toxicity"] < docs.count() and counts["minhash_near_dedup"] < counts["toxicity"]
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
