"""Conversation trie against plain Python, on small tables with nulls, ties, copies and many ranges, and on all supplied conversations."""

import collections
import hashlib
import os
import random
import zlib

import pytest

from matchloom.llm import prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, c long, at long, token int, size string, cut int, key int, _k int"


def sequences(rows):
    """Rebuilt conversations; ties of a turn by the operator's hash."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(role.encode() + b"\xff" + text.encode()).digest()[:16], role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - c % 100, [])[:h] + ts[h:])
    return out


def plain_trie(rows):
    members = collections.defaultdict(list)
    for c, s in sequences(rows).items():
        for d in range(len(s) + 1):
            members[s[:d]].append((c, len(s)))
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not children[p]
        saved[p] += (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    low = {p: min(m)[0] for p, m in members.items()}
    ends = {p: hashlib.sha256(",".join(str(c) for c, n in sorted(m) if n == len(p)).encode()).hexdigest() for p, m in members.items()}
    return sorted(((low[p], len(p), low[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p], ends[p]) for p, m in members.items()), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def conversations(n, seed):
    rnd = random.Random(seed)
    said = ["", None, "é", "hello", "how are you", "fine"]
    rows = []
    for c in rnd.sample(range(0, 5 * n), n):
        kind = rnd.random()
        turns = [("user", "always the same")] * 3 if kind < 0.35 else [(rnd.choice(["user", "assistant", None]), rnd.choice(said)) for _ in range(rnd.randint(1, 9))]
        turns = turns * 30 if kind > 0.98 else turns
        rows += [(c, i if rnd.random() < 0.97 else None, r, t) for i, (r, t) in enumerate(turns)]
    rows += [rows[0], rows[5], (rows[9][0], rows[9][1], "user", "a tie"), (None, 1, "user", "of no conversation"), (-7, 0, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "parts"), [(40, 3), (1500, 8)])
def test_trie(spark, n, parts):
    rows = conversations(n, n)
    df = spark.createDataFrame([(*r, 1, 2, 3, "s", 4, 5, 6) for r in rows], SCHEMA).repartition(parts)
    want = plain_trie(rows)
    assert found(prefix_trie.trie(df)) == want
    assert max(w[3] for w in want if w[1]) > n // 10
    assert prefix_trie.trie(df.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_supplied_conversations(spark, sf):
    path = f"/root/testdata/{sf}/conversations.parquet"
    if not os.path.exists(path):
        pytest.skip("no supplied tables")
    df = spark.read.parquet(path)
    assert found(prefix_trie.trie(df)) == plain_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_ranges_cut_hot_copies(spark):
    """Half of all conversations are one text: its copies lie in many ranges, and their ids still give one digest."""
    rows = [(c, t, "user", f"turn {t}" if c % 2 else f"own {c % 97} {t}") for c in range(2000) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(prefix_trie.trie(df)) == plain_trie(rows)
