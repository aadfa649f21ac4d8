"""Removal of repeated passages of words by phrase automata.

Every window of `window` words has an anchor, its smallest 8-word hash. Only windows whose anchor occurs twice can recur;
shards exchange anchors first, then the 96-bit hashes of those windows with their first place. Each shard thus learns which
of its windows start earlier elsewhere, joins neighbours of one source to passages, compiles the passages to Aho-Corasick
automata of bounded size and streams all its documents through them; every hit that starts later than its source is removed.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import common as C

GRAM = 8
NODES = 600_000
ALPHABET = "".join(map(chr, range(48, 112)))
PLACE = np.dtype([("a", "<u8"), ("b", "<u4"), ("d", "<i8"), ("s", "<i4"), ("m", "u1")])
FIRST = np.dtype([("a", "<u8"), ("b", "<u4"), ("d", "<i8"), ("s", "<i4")])
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


class Shard:
    """The documents of one shard in a fixed order, with their word hashes."""

    def __init__(self, pdf: pd.DataFrame, window: int):
        null = pdf["id"].isna()
        self.null = null.to_numpy()
        self.ids = pdf["id"].astype("object").where(~null, C.LAST).astype(np.int64).to_numpy()
        self.window, self.gram = window, min(GRAM, window)
        seen = C.WordHash()
        self.words = [C.words(t) for t in pdf["text"]]
        self.hashes = [seen.of(w) for w in self.words]

    def anchors(self):
        for x in self.hashes:
            yield C.anchors(C.gram_hash(x, self.gram), self.window - self.gram + 1), x

    def windows(self, known: np.ndarray | None, places: bool = True) -> np.ndarray:
        """Places of all windows whose anchor is known (all windows for None); m holds the document's position."""
        parts = []
        for k, x in enumerate(self.hashes):
            if len(x) < self.window:
                continue
            a = C.gram_hash(x, self.window, 1)
            if known is None:
                at = np.arange(len(a))
            else:
                low, _ = C.anchors(C.gram_hash(x, self.gram), self.window - self.gram + 1)
                at = np.flatnonzero(C.member(low, known))
            if not len(at):
                continue
            out = np.zeros(len(at), PLACE)
            out["a"], out["b"], out["d"], out["s"] = a[at], C.gram_hash(x, self.window, 2)[at], self.ids[k], at
            parts.append(out)
        return np.concatenate(parts) if parts else np.zeros(0, PLACE)


def send_anchors(window: int, n_buckets: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = [C.gram_hash(x, min(GRAM, window))[chosen] for (_, chosen), x in Shard(pdf, window).anchors() if len(chosen)]
        rows = C.counted(np.concatenate(found)) if found else np.zeros(0, C.COUNTED)
        return C.packed(key[0], rows, rows["h"], n_buckets)

    return run


def send_windows(window: int, n_buckets: int):
    def run(key: tuple, pdf: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        known = np.sort(C.unpacked(back, C.COUNTED)[0]["h"])
        if not len(pdf) or not len(known):
            return pd.DataFrame(columns=["bucket", "shard", "kind", "data"])
        rows = firsts(Shard(pdf, window).windows(known))
        return C.packed(key[0], rows, rows["a"], n_buckets)

    return run


def firsts(rows: np.ndarray) -> np.ndarray:
    """The first place of each window; m is set if it has others, here or already."""
    rows = rows[np.lexsort((rows["s"], rows["d"], rows["b"], rows["a"]))]
    if not len(rows):
        return rows
    new = np.concatenate([[True], (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(rows)))
    out = rows[at].copy()
    out["m"] = np.maximum(np.maximum.reduceat(rows["m"], at), (size > 1).astype(np.uint8))
    return out


def meet_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """To each shard the first place of those of its windows that also stand elsewhere."""
    rows, shard = C.unpacked(pdf, PLACE)
    order = np.lexsort((rows["s"], rows["d"], rows["b"], rows["a"]))
    rows, shard = rows[order], shard[order]
    if not len(rows):
        return C.reply(np.zeros(0, FIRST), shard)
    new = np.concatenate([[True], (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])])
    at = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    first = rows[at][group]
    need = (size[group] > 1) & ~new | (rows["m"] > 0)
    out = np.zeros(int(need.sum()), FIRST)
    for c in FIRST.names:
        out[c] = first[c][need]
    return C.reply(out, shard[need])


def passages(shard: Shard, first: np.ndarray) -> dict[tuple, tuple[int, int]]:
    """Maximal runs of this shard's windows that continue one earlier source: words -> the source's place."""
    first = first[np.lexsort((first["b"], first["a"]))]
    fa, fb, fd, fs = (np.ascontiguousarray(first[c]) for c in ("a", "b", "d", "s"))
    found: dict[tuple, tuple[int, int]] = {}
    for k, x in enumerate(shard.hashes):
        if len(x) < shard.window:
            continue
        a = C.gram_hash(x, shard.window, 1)
        at = np.minimum(np.searchsorted(fa, a), len(fa) - 1)
        same = fa[at] == a
        if not same.any():
            continue
        b = C.gram_hash(x, shard.window, 2).astype(np.uint32)
        while True:  # equal first parts are next to each other
            behind = same & (fb[at] < b) & (at + 1 < len(fa))
            if not behind.any():
                break
            at = at + behind
            same = fa[at] == a
        d, s = fd[at], fs[at].astype(np.int64)
        here = np.arange(len(a))
        hit = same & (fb[at] == b) & ((d < shard.ids[k]) | (d == shard.ids[k]) & (s < here))
        for lo, hi in zip(*C.joined_runs(hit), strict=True):
            cut = np.flatnonzero((np.diff(d[lo:hi]) != 0) | (np.diff(s[lo:hi]) != 1)) + lo + 1
            for i, j in zip([lo, *cut], [*cut, hi], strict=True):
                key = tuple(shard.words[k][i : j - 1 + shard.window])
                place = (int(d[i]), int(s[i]))
                found[key] = min(found.get(key, place), place)
    return found


def automata(found: dict[tuple, tuple[int, int]], code: dict[bytes, str]):
    """Aho-Corasick automata over fixed-width word codes, each of a bounded number of nodes."""
    nodes, machine = 0, None
    for key, place in found.items():
        if machine is None:
            machine = ahocorasick.Automaton()
        machine.add_word("".join(map(code.__getitem__, key)), (len(key), place))
        nodes += len(key) * 3
        if nodes >= NODES:
            machine.make_automaton()
            yield machine
            nodes, machine = 0, None
    if machine is not None:
        machine.make_automaton()
        yield machine


def removed_words(shard: Shard, first: np.ndarray) -> list[np.ndarray]:
    gone = [np.zeros(len(w), bool) for w in shard.words]
    if not len(first):
        return gone
    found = passages(shard, first)
    code: dict[bytes, str] = {}
    n, width = len(ALPHABET), 3
    while n**width <= sum(map(len, found)):
        width += 1
    for key in found:
        for w in key:
            if w not in code:
                v, digits = len(code), []
                for _ in range(width):
                    v, r = divmod(v, n)
                    digits.append(ALPHABET[r])
                code[w] = "".join(digits)
    other = "!" * width
    for machine in automata(found, code):
        for k, ws in enumerate(shard.words):
            me = int(shard.ids[k])
            for end, (length, place) in machine.iter("".join([code.get(w, other) for w in ws])):
                stop, odd = divmod(end + 1, width)
                if not odd and place < (me, stop - length):
                    gone[k][stop - length : stop] = True
    return gone


def finish(window: int, with_text: bool, carried: int = 0):
    def run(key: tuple, pdf: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(pdf, window)
        gone = removed_words(shard, C.unpacked(back, FIRST)[0])
        kept = [b" ".join([w for w, g in zip(ws, x.tolist(), strict=True) if not g] if x.any() else ws) for ws, x in zip(shard.words, gone, strict=True)]
        out = pd.DataFrame({"doc_id": pd.array(pdf["id"], "Int64"), "n_words": [len(w) for w in shard.words], "n_removed": [int(x.sum()) for x in gone]})
        out["kept_sha256"] = [hashlib.sha256(x).hexdigest() for x in kept]
        out["kept_text"] = [x.decode("utf-8", "replace") for x in kept] if with_text else None
        if carried:
            out["text"] = pdf["text"].to_numpy()
            for k in range(carried):
                out[f"carry_{k}"] = pdf[f"carry_{k}"].to_numpy()
        return out

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, with_text: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text), one row for each input row.

    A word goes if a window of `window` words that covers it also starts earlier: in a document of smaller id, or earlier in
    its own. Null text has no words; texts shorter than a window are kept; a null id counts as the largest id; rows of the
    same id stand at the same place, so neither removes the other. Of extra columns nothing is read. An empty table
    gives no rows. With `carry`, the input's text follows as `text`, and the named columns as carry_0, carry_1 and so on."""
    docs, n = C.sharded(df, id_col, text_col, carry)
    n_buckets = C.bucket_count(n)
    by = docs.groupBy("shard")
    known = C.recurring_anchors(by.applyInPandas(send_anchors(window, n_buckets), C.PACKED), 1 << 31)
    places = by.cogroup(known.groupBy("shard")).applyInPandas(send_windows(window, n_buckets), C.PACKED)
    back = places.groupBy("bucket").applyInPandas(meet_windows, C.REPLY)
    more = "".join(f", carry_{k} {df.schema[c].dataType.simpleString()}" for k, c in enumerate(carry))
    return by.cogroup(back.groupBy("shard")).applyInPandas(finish(window, with_text, len(carry)), RESULT + (", text string" + more if carry else ""))
