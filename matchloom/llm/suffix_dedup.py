"""Removal of repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every window of `length` bytes has an anchor, its smallest 16-byte hash, so equal windows have equal anchors. Shards exchange
anchors; runs of windows that share a recurring anchor are cut out as segments and meet in that anchor's bucket. There equal
segments are counted once, and different ones are concatenated to blocks of bounded size. Stretches of a block that repeat at
all give its suffix order and transform; from the intervals of all 128-byte strings on, level by level, backward extension of
the intervals split so far derives the common prefixes of each value, and stops at `length`: what is still unsplit then begins a repeated string. Anchors with more than `hot` places (a passage that
very many documents share, in ever other surroundings) would make a block too large; their windows meet by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import common as C

GRAM = 16
BLOCK = 1 << 20
HOT = 1000
PRE = 128
START = 128
SPAN = np.dtype([("row", "<i4"), ("s", "<i4"), ("e", "<i4")])
WINDOW = np.dtype([("a", "<u8"), ("b", "<u8"), ("m", "u1")])
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def byte_grams(b: bytes) -> np.ndarray:
    """Hash of every 16 bytes."""
    n = len(b)
    if n < GRAM:
        return np.zeros(0, np.uint64)
    u = np.empty(n - 7, np.uint64)
    for j in range(8):
        v = np.frombuffer(b, "<u8", (n - j) // 8, j)
        u[j::8] = v
    return C.mix(C.mix(u[:-8]) * C.C1 + u[8:])


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks by prefix doubling; only suffixes that still tie are sorted again.

    Symbols are below 2**20 and the separators among them are unique, so the order is total."""
    n = len(symbols)
    s = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(2, np.int64)])
    key = (s[:-2] << 42) | (s[1:-1] << 21) | s[2:]
    order = np.argsort(key, kind="stable")
    sk = key[order]
    first = np.concatenate([[True], sk[1:] != sk[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    last = np.append(first[1:], True)
    active, k = order[~(first & last)], 3
    while len(active):
        ahead = active + k
        key = rank[active] * (n + 2) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        o = np.argsort(key, kind="stable")
        active, sk = active[o], key[o]
        old = rank[active]
        here = np.arange(len(active))
        old_first = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), here, 0))
        first = np.concatenate([[True], sk[1:] != sk[:-1]])
        at = np.maximum.accumulate(np.where(first, here, 0))
        rank[active] = old + at - old_first
        active = active[~(first & np.append(first[1:], True))]
        k *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, rank


def common_prefix_reaches(symbols: np.ndarray, n_separators: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and for each rank whether its suffix shares `length` symbols or more with the one before.

    Splits of value v lie between ranks whose suffixes share exactly v symbols. If a split lies between two neighbouring
    places p < q of a symbol in the transform, extending both backward by that symbol splits their images, one value higher.
    Values are derived in increasing order, each split once, and only below `length`."""
    n = len(symbols)
    order, rank = suffix_order(symbols)
    bwt = symbols[order - 1]
    image = rank[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    same = (bwt[by_symbol][1:] == bwt[by_symbol][:-1]) & (bwt[by_symbol][1:] >= n_separators)
    before = np.full(n, -1, np.int64)
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    # the intervals of all strings of `start` symbols; among their borders those of value start - 1 are the newest
    start = min(START, length)
    codes = C.mix(symbols.astype(np.uint64) * C.C1 + C.C2)
    shorter, split = differ(codes, order, start - 1), differ(codes, order, start)
    new = np.flatnonzero(split[:n] & ~shorter[:n])
    todo = np.flatnonzero(before >= 0)
    todo = todo[~split[image[todo]]]
    heads = np.flatnonzero((before >= 0) & (before != np.arange(n) - 1))
    behind = np.searchsorted(heads, np.arange(n), "right")
    sums = np.cumsum(split[:n])
    for level in range(start, length):
        if not len(new):
            break
        at = near_places(new, before, heads, behind, sums)
        if at is None:
            todo = todo[~split[image[todo]]]
            sums = np.cumsum(split[:n])
            at = todo[sums[todo] > sums[before[todo]]]
        elif level % 32 == 0:
            sums = np.cumsum(split[:n])
        targets = image[at]
        new = np.unique(targets[~split[targets]])
        split[new] = True
    return order, ~split[:n]


def differ(codes: np.ndarray, order: np.ndarray, size: int) -> np.ndarray:
    """For each rank whether its first symbols differ from those of the rank before; true behind the last."""
    n = len(codes)
    grams = np.concatenate([C.gram_hash(codes, size), C.mix(np.arange(min(size - 1, n), dtype=np.uint64) + C.C3)])[order] if size else np.zeros(n, np.uint64)
    return np.concatenate([[True], grams[1:] != grams[:-1], [True]])


def near_places(new: np.ndarray, before: np.ndarray, heads: np.ndarray, behind: np.ndarray, sums: np.ndarray) -> np.ndarray | None:
    """The places q whose earlier neighbour of the same symbol lies on the other side of a new split j <= q.

    Besides j itself only heads of runs can be such places, up to the next older split, which has reached those behind it;
    `sums` counts splits, perhaps not the newest. None if there are too many heads to look at."""
    out, j, h = [new[before[new] >= 0]], new, behind[new]
    for step in range(400):
        go = h < len(heads)
        j, h = j[go], h[go]
        q = heads[h]
        go = sums[q] == sums[j]
        j, h, q = j[go], h[go] + 1, q[go]
        if not len(q):
            return np.concatenate(out)
        if step > 24 and len(q) * 64 > len(before):
            return None
        out.append(q[before[q] < j])
    return None


def repeated_starts(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment which starts begin a string of `length` bytes that also starts elsewhere in these segments.

    Stretches whose shorter grams are unique cannot hold one; only the others, equal ones once, go to the transform."""
    sizes = np.array([len(x) for x in segments])
    ends = np.cumsum(sizes)
    text = b"".join(segments)
    gram = min(PRE, length)
    grams = C.gram_hash(byte_grams(text), gram - GRAM + 1)
    room = np.repeat(ends, sizes)[: len(grams)] - np.arange(len(grams)) >= gram
    order = np.argsort(grams)
    same = grams[order][1:] == grams[order][:-1]
    again = np.zeros(len(grams), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    pieces: dict[bytes, list[int]] = defaultdict(list)
    for s, e in zip(*C.joined_runs(again & room), strict=True):
        if e - s + gram - 1 >= length:
            pieces[text[s : e + gram - 1]].append(int(s))
    starts = np.zeros(len(text), bool)
    for piece, reaches in zip(pieces, transform_repeats(list(pieces), length), strict=True):
        flags = reaches | (len(pieces[piece]) > 1)
        for s in pieces[piece]:
            starts[s : s + len(flags)] = flags
    return [starts[e - n : e - length + 1] for n, e in zip(sizes, ends, strict=True)]


def transform_repeats(segments: list[bytes], length: int) -> list[np.ndarray]:
    if not segments:
        return []
    sizes = np.array([len(x) for x in segments])
    m = len(segments)
    symbols = np.empty(int(sizes.sum()) + m, np.int64)
    place = np.concatenate([[0], np.cumsum(sizes + 1)])
    for k, x in enumerate(segments):
        symbols[place[k] : place[k + 1] - 1] = np.frombuffer(x, np.uint8)
        symbols[place[k] : place[k + 1] - 1] += m
        symbols[place[k + 1] - 1] = k
    order, reaches = common_prefix_reaches(symbols, m, length)
    either = reaches | np.append(reaches[1:], False)
    starts = np.zeros(len(symbols), bool)
    starts[order[either]] = True
    return [starts[place[k] : place[k + 1] - length] for k in range(m)]


class Shard:
    def __init__(self, pdf: pd.DataFrame, length: int):
        """Rows in a fixed order, whatever order the shuffle delivers them in."""
        texts = [C.encoded(t) for t in pdf["text"]]
        ids = [None if pd.isna(i) else int(i) for i in pdf["id"]]
        rows = sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.ids, self.texts = [r[0] for r in rows], [r[1] for r in rows]
        self.length = length

    def anchors(self):
        for k, b in enumerate(self.texts):
            if len(b) >= self.length:
                g = byte_grams(b)
                yield k, b, g, *C.anchors(g, self.length - GRAM + 1)


def send_anchors(length: int, n_buckets: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = [g[chosen] for _, _, g, _, chosen in Shard(pdf, length).anchors()]
        rows = C.counted(np.concatenate(found)) if found else np.zeros(0, C.COUNTED)
        return C.packed(key[0], rows, rows["h"], n_buckets)

    return run


def window_hashes(grams: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    return C.gram_hash(grams, length - GRAM + 1, 1), C.gram_hash(grams, length - GRAM + 1, 2)


def distinct_windows(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort((rows["b"], rows["a"]))]
    if not len(rows):
        return rows
    at = np.flatnonzero(np.concatenate([[True], (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])]))
    out = rows[at].copy()
    out["m"] = np.maximum(np.maximum.reduceat(rows["m"], at), np.diff(np.append(at, len(rows))) > 1)
    return out


def send_segments(length: int, n_buckets: int):
    def run(key: tuple, pdf: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        known = C.unpacked(back, C.COUNTED)[0]
        known = known[np.argsort(known["h"])]
        if not len(known) or not len(pdf):
            return pd.DataFrame(columns=["bucket", "shard", "kind", "data"])
        few, many = known["h"][known["n"] == 1], known["h"][known["n"] == 2]
        segments: dict[tuple[int, bytes], list[tuple[int, int]]] = defaultdict(list)
        hot, rows_with_hot = [], []
        for k, b, g, low, _ in Shard(pdf, length).anchors():
            for s, e in zip(*C.joined_runs(C.member(low, few)), strict=True):
                cut = np.flatnonzero(low[s + 1 : e] != low[s : e - 1]) + s + 1
                for i, j in zip([s, *cut.tolist()], [*cut.tolist(), e], strict=True):
                    segments[int(low[i]), b[i : j - 1 + length]].append((k, int(i)))
            if len(many) and (at := C.member(low, many)).any():
                rows_with_hot.append(k)
                ha, hb = window_hashes(g, length)
                w = np.zeros(int(at.sum()), WINDOW)
                w["a"], w["b"] = ha[at], hb[at]
                hot.append(w)
        parts = defaultdict(list)
        for (h, text), places in segments.items():
            parts[(h >> 32) % n_buckets].append((h, text, places))
        out = [pd.DataFrame({"bucket": list(parts), "shard": key[0], "kind": 0, "data": [pickle.dumps(x, 5) for x in parts.values()]})]
        if hot:
            w = distinct_windows(np.concatenate(hot))
            out.append(C.packed(key[0], w, w["a"], n_buckets, 1))
            out.append(pd.DataFrame({"bucket": [key[0] % n_buckets], "shard": [key[0]], "kind": [2], "data": [np.array(rows_with_hot, "<i4").tobytes()]}))
        return pd.concat(out).astype({"bucket": "int32", "shard": "int32", "kind": "int32"})

    return run


def meet_segments(length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        groups: dict[int, dict[bytes, list]] = defaultdict(lambda: defaultdict(list))
        for shard, data in zip(pdf["shard"][pdf["kind"] == 0], pdf["data"][pdf["kind"] == 0], strict=True):
            for h, text, places in pickle.loads(data):
                groups[h][text] += [(shard, *p) for p in places]
        spans: dict[int, list] = defaultdict(list)
        block: list[tuple[bytes, list]] = []

        def mark(places, starts):
            for s, e in zip(*C.joined_runs(starts), strict=True):
                for shard, row, at in places:
                    spans[shard].append((row, at + s, at + e - 1 + length))

        def expand():
            for (_, places), starts in zip(block, repeated_starts([x for x, _ in block], length), strict=True):
                mark(places, starts | (len(places) > 1))
            block.clear()

        filled = 0
        for texts in groups.values():
            if len(texts) == 1:
                (text, places), = texts.items()
                if len(places) > 1 or len(text) > length:
                    mark(places, np.full(len(text) - length + 1, True) if len(places) > 1 else repeated_starts([text], length)[0])
                continue
            block += texts.items()
            filled += sum(map(len, texts))
            if filled >= BLOCK:
                expand()
                filled = 0
        if block:
            expand()
        found = [pd.DataFrame({"shard": list(spans), "kind": 0, "data": [np.array(x, SPAN).tobytes() for x in spans.values()]})]
        rows, shard = C.unpacked(pdf[pdf["kind"] == 1], WINDOW)
        if len(rows):
            o = np.lexsort((rows["b"], rows["a"]))
            rows, shard = rows[o], shard[o]
            new = np.concatenate([[True], (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])])
            group = np.cumsum(new) - 1
            keep = (np.bincount(group)[group] > 1) | (rows["m"] > 0)
            found.append(C.reply(rows[keep], shard[keep], 1))
        found.append(pdf.loc[pdf["kind"] == 2, ["shard", "kind", "data"]])  # to the sender itself
        return pd.concat(found).astype({"shard": "int32", "kind": "int32"})

    return run


def finish(length: int, with_text: bool):
    def run(key: tuple, pdf: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(pdf, length)
        gone: dict[int, np.ndarray] = {}
        spans = C.unpacked(back[back["kind"] == 0], SPAN)[0]
        for row in np.unique(spans["row"]):
            x = spans[spans["row"] == row]
            d = np.zeros(len(shard.texts[row]) + 1, np.int32)
            np.add.at(d, x["s"], 1)
            np.add.at(d, x["e"], -1)
            gone[int(row)] = np.cumsum(d[:-1]) > 0
        hot = np.sort(C.unpacked(back[back["kind"] == 1], WINDOW)[0], order=["a", "b"])
        hot_a, hot_b = np.ascontiguousarray(hot["a"]), np.ascontiguousarray(hot["b"])
        if len(hot):
            for k in C.unpacked(back[back["kind"] == 2], "<i4")[0].tolist():
                b = shard.texts[k]
                ha, hb = window_hashes(byte_grams(b), length)
                at = np.minimum(np.searchsorted(hot_a, ha), len(hot) - 1)
                hit = (hot_a[at] == ha) & (hot_b[at] == hb)
                if hit.any():
                    gone[k] = gone.get(k, np.zeros(len(b), bool)) | C.covered(hit, length, len(b))
        kept = [np.frombuffer(b, np.uint8)[~gone[k]].tobytes() if k in gone else b for k, b in enumerate(shard.texts)]
        return pd.DataFrame({
            "doc_id": pd.array(shard.ids, "Int64"), "n_bytes": [len(b) for b in shard.texts], "n_removed": [len(b) - len(x) for b, x in zip(shard.texts, kept, strict=True)],
            "n_spans": [len(C.joined_runs(gone[k])[0]) if k in gone else 0 for k in range(len(kept))],
            "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept], "kept": kept if with_text else None,
        })

    return run


def remove_repeated_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, hot: int = HOT, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept), one row for each input row.

    A byte goes if a string of `length` (at least 16) bytes that covers it also starts anywhere else, in its own document
    included; matches do not cross documents. Null text has no bytes, texts shorter than `length` are kept, null ids stay
    null, repeated rows are copies of each other, extra columns are not read. An empty table gives no rows. What is kept may
    begin or end inside a character, so it is returned as bytes."""
    docs, n = C.sharded(df, id_col, text_col)
    n_buckets = C.bucket_count(n)
    by = docs.groupBy("shard")
    known = C.recurring_anchors(by.applyInPandas(send_anchors(length, n_buckets), C.PACKED), hot)
    sent = by.cogroup(known.groupBy("shard")).applyInPandas(send_segments(length, n_buckets), C.PACKED)
    back = sent.groupBy("bucket").applyInPandas(meet_segments(length), C.REPLY)
    return by.cogroup(back.groupBy("shard")).applyInPandas(finish(length, with_text), RESULT)
