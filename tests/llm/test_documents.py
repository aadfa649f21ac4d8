"""Operators over documents against brute force, on small tables with nulls, empty, long and repeated texts and clashing columns."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from matchloom.llm import lattice_lm, minhash_dedup, mixing, packing, phrase_dedup, suffix_dedup
from matchloom.llm.queries import SQL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, shard int, k string, size long, bucket int"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def corpus(n=60, seed=3):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeßéñ") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    word = lambda: rnd.choice(vocabulary) + rnd.choice(["", "", ",", "."])
    shared = [[word() for _ in range(rnd.randint(25, 90))] for _ in range(4)]
    texts = [None, "", "  \t\n", "one", "a b c d", "x " * 300, "Ünïcode\u2003one word\x1cstill"]
    for i in range(n):
        ws = [word() for _ in range(rnd.randint(0, 120))]
        if i % 3 == 0:
            at = rnd.randint(0, len(ws))
            ws[at:at] = rnd.choice(shared)[rnd.randint(0, 5) :]
        texts.append(rnd.choice([" ", "\n", "  "]).join(ws))
    texts += [texts[9], texts[9].upper(), texts[12] + " end", " ".join(word() for _ in range(4000))]
    rows = [(i * 3, t, "en", rnd.choice(["a", "b", None, "é", "Z"]), len(t or ""), 7, 1, "k", 5, 2) for i, t in enumerate(texts)]
    return rows + [(None, texts[10], "en", None, 1, 7, 1, "k", 5, 2), (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def words(t):
    return (t or "").encode().split()


def test_phrases(docs, empty):
    rows = [(1 << 63 if r[0] is None else r[0], r[0], words(r[1])) for r in corpus()]
    first = {}
    for i, _, w in rows:
        for s in range(len(w) - 19):
            first[tuple(w[s : s + 20])] = min(first.get(tuple(w[s : s + 20]), (i, s)), (i, s))
    want = []
    for i, d, w in rows:
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] < (i, s):
                gone[s : s + 20] = [True] * 20
        want.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    cols = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert found(phrase_dedup.remove_repeats(docs), *cols) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 200
    assert phrase_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("hot", [1000, 1])
def test_repeated_bytes(docs, empty, hot):
    texts = [(r[0], (r[1] or "").encode()) for r in corpus()]
    count = collections.Counter(t[s : s + 100] for _, t in texts for s in range(len(t) - 99))
    want = []
    for d, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - 99):
            if count[t[s : s + 100]] > 1:
                gone[s : s + 100] = b"\1" * 100
        spans = sum(g and not p for g, p in zip(gone, [0, *gone]))
        want.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found(suffix_dedup.remove_repeated_bytes(docs, length=100, hot=hot), *cols) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 500
    assert suffix_dedup.remove_repeated_bytes(empty, length=100).count() == 0


def test_repeated_bytes_at_full_length(spark, monkeypatch):
    """The contract's 400 bytes over several shards, with anchors beyond `hot` places, blocks beyond BLOCK, and passages of over
    50 words on both sides of 400 bytes: those below are no repeat by the contract, those above are all removed."""
    import xxhash

    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9)))
    long, short = [" ".join(word() for _ in range(90)) for _ in range(30)], [" ".join("".join(rnd.choice("abc") for _ in range(5)) for _ in range(55)) for _ in range(30)]
    common = " ".join(word() for _ in range(80))
    assert min(map(len, long)) >= 400 > max(map(len, short))
    texts = [" ".join(word() for _ in range(rnd.randint(30, 160))) + f" {i} " + (common if i % 4 < 3 else rnd.choice(long + short)) + " " + word() for i in range(1600)]
    texts += [t for t in texts[:300] for _ in range(2)] + [" ".join(texts[:40]), None, ""]
    assert sum(len(t or "") for t in texts) > 2 * suffix_dedup.BLOCK
    count = collections.Counter(xxhash.xxh3_64_intdigest(b[s : s + 400]) for t in texts for b in [(t or "").encode()] for s in range(len(b) - 399))
    want = []
    for i, t in enumerate(texts):
        b, gone = (t or "").encode(), np.zeros(len(t or "") + 1, np.int32)
        for s in range(len(b) - 399):
            if count[xxhash.xxh3_64_intdigest(b[s : s + 400])] > 1:
                gone[s] += 1
                gone[s + 400] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        want.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    monkeypatch.setattr(suffix_dedup.C, "SHARD_BYTES", 300_000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found(suffix_dedup.remove_repeated_bytes(df), *cols) == sorted(want, key=repr)
    for passage in [common, *long]:
        holders = [i for i, t in enumerate(texts) if passage in (t or "")]
        assert len(holders) < 2 or all(want[i][2] >= 400 for i in holders)


def test_transform_equals_brute_force():
    rnd = random.Random(5)
    for _ in range(40):
        segments = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(20, 90))) for _ in range(rnd.randint(1, 6))]
        segments += [segments[0]] * rnd.randint(0, 2) + [b"a" * 40] * rnd.randint(0, 1)
        count = collections.Counter(x[s : s + 18] for x in segments for s in range(len(x) - 17))
        got = suffix_dedup.repeated_starts(segments, 18)
        assert [list(g) for g in got] == [[count[x[s : s + 18]] > 1 for s in range(len(x) - 17)] for x in segments]


def near(rows, share=85):
    up, sets = {}, {}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, t in rows:
        w = (t or "").encode().translate(LOWER).split()
        sets[i] = {tuple(w[s : s + 5]) for s in range(max(1, len(w) - 4))} if w else set()
        up[i] = i
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= share * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in up}


def test_near_documents(spark, empty):
    rnd = random.Random(8)
    rows = [(r[0], r[1]) for r in corpus() if r[0] is not None]
    base = [f"w{rnd.randint(0, 999)}" for _ in range(150)]
    for i in range(40):  # a chain: neighbours are near, the ends are not
        base[(7 * i) % 150] = f"n{i}"
        rows.append((1000 + i, " ".join(base)))
    want = near(rows)
    df = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows] + [(None, rows[9][1], 1, "x", 2, 3)], "doc_id long, text string, id int, sig string, n int, component int")
    got = {r["doc_id"]: r for r in minhash_dedup.near_documents(df).collect()}
    assert {i: (got[i]["n_shingles"], got[i]["component_id"]) for i in want} == want
    assert all(got[i]["kept"] == (want[i][1] == i) for i in want) and got[None]["kept"]
    assert len({c for _, c in want.values()}) < len(want) - 30
    assert minhash_dedup.near_documents(empty).count() == 0


def test_distance_and_chunks_follow_from_the_share():
    assert minhash_dedup.reach(85) == (41, 21) and minhash_dedup.reach(80) == (49, 25)
    for share in range(80, 100):
        far, chunks = minhash_dedup.reach(share)
        p = share / 100
        assert sum(math.comb(128, k) * (1 - p) ** k * p ** (128 - k) for k in range(far + 1, 129)) < 1e-6 and chunks * 2 > far


def test_pipeline_stage_links_from_four_fifths(spark):
    import corpus_pipeline

    rnd = random.Random(6)
    rows = []
    for k in range(30):  # pairs of similarity from 0.76 to 0.88, changed from the end on
        ws = [f"w{rnd.randint(0, 9999)}" for _ in range(204)]
        other = ws[: 180 + k // 2] + [f"v{j}" for j in range(24 - k // 2)]
        rows += [(2 * k, " ".join(ws)), (2 * k + 1, " ".join(other))]
    want, strict = near(rows, 80), near(rows)
    kept = {i for i, (_, c) in want.items() if i == c}
    assert len(kept) < len({c for _, c in strict.values()}) and len(kept) > 30
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r["doc_id"] for r in got.collect()} == kept


def test_lattice_scores(docs, empty):
    rows = [(r[0], [*(r[1] or "").encode().translate(LOWER).split(), b""]) for r in corpus()]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    count = collections.Counter(w for d, ws in rows if not held(d) for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted(((d, held(d), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws in rows), key=repr)
    out = lattice_lm.lattice_scores(docs).collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out), key=repr)
    assert got == want and all(r.score < 0 for r in out)
    assert lattice_lm.lattice_scores(empty).count() == 0


def test_lattice_sums_all_segmentations():
    lattice = lattice_lm.Lattice(lattice_lm.default_vocabulary(), {300: 5.0, 400: 2.0, lattice_lm.END: 3.0})

    def total(s):
        if not s:
            return 1.0
        p = sum(math.exp(lattice.piece[s[:k]]) * total(s[k:]) for k in range(1, len(s) + 1) if s[:k] in lattice.piece)
        if s[0] not in lattice.piece:
            p += math.exp(sum(lattice.byte[b] for b in s[0].encode())) * total(s[1:])
        return p

    for word in ("a", "the", "walking", "ñandú", "q\u1e9dx"):
        assert math.isclose(lattice.word(word), math.log(total(lattice_lm.MARK + word)), rel_tol=1e-9)
    everything = sum(math.exp(p) for p in lattice.piece.values()) + sum(map(math.exp, lattice.byte)) + math.exp(lattice.end)
    assert 0.99 < everything <= 1.0 + 1e-9


def test_packing_round_trip(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    want = collections.Counter()
    for r in corpus():
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 256):
            part = ids[k : k + 256]
            want[(r[0], k // 256, k, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))] += 1
    out = packing.pack(docs, limit=256).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    places = collections.defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 256
    assert len(places) <= math.ceil(sum(r.length for r in out) / 256) * 1.1 + 1
    assert packing.pack(empty).count() == 0


def test_placing_rule_equals_brute_force():
    """Every open sequence and a new one are tried; the smallest sum of squares wins, among equal sums the smallest gap."""
    rnd = random.Random(8)
    for limit in (7, 40):
        lengths = sorted((rnd.randint(1, limit) for _ in range(400)), reverse=True) + [rnd.randint(1, limit) for _ in range(200)]
        sequence, offset, n = packing.sum_of_squares(np.array(lengths), limit)
        gaps: list[int] = []  # by sequence
        for s, to, at in zip(lengths, sequence.tolist(), offset.tolist()):
            def cost(place, s=s):
                after = [g - s if k == place else g for k, g in enumerate([*gaps, limit] if place == len(gaps) else gaps)]
                return sum(v * v for g, v in collections.Counter(after).items() if g)

            choices = [k for k, g in enumerate(gaps) if g >= s] + [len(gaps)]
            gap = lambda k: gaps[k] if k < len(gaps) else limit + 1
            best = min(choices, key=lambda k: (cost(k), gap(k)))
            assert (cost(to), gap(to)) == (cost(best), gap(best))
            if to == len(gaps):
                gaps.append(limit)
            assert at == limit - gaps[to]
            gaps[to] -= s
        assert n == len(gaps)


def test_special_and_odd_runs_tokenize_like_the_library():
    from tokenizers import Tokenizer

    tokenizer, own = Tokenizer.from_file(packing.default_vocabulary()), packing.Tokens(packing.default_vocabulary(), 50)
    rnd = random.Random(2)
    for k in range(3000):
        text = "".join(rnd.choice("aAbZéßÇİıΣς'’1½²ª—“<|>sndt\u0301ﬁ \xa0\u2003\x1c#\n日") for _ in range(rnd.randint(0, 12))) if k else "a<|endoftext|>it's"
        assert own.of(text) == b"".join(i.to_bytes(4, "little") for i in tokenizer.encode(text, add_special_tokens=False).ids)


def test_mix_equals_sql_and_meets_targets(spark, docs, empty):
    import duckdb

    out = mixing.mix(docs).collect()
    data = spark.createDataFrame(corpus(), SCHEMA).select("doc_id", "text", "source").toPandas()
    data["doc_id"] = data["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", data)
    want = collections.Counter(con.execute(SQL["op10_source_mix"].replace("x.k = g.k", "x.k = g.k AND x.doc_id IS NOT NULL")).fetchall())
    got = collections.Counter((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in out)
    keep = lambda c: {(k[0], *k[1:]): n for k, n in c.items() if k[0] is not None}
    assert keep(got) == keep(want)
    largest = max(r["size"] for r in out)
    taken = collections.Counter()
    for r in out:
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for r in out:
        assert abs(taken[r["source"]] - r["target"]) <= largest + 1
    assert mixing.mix(empty).count() == 0
