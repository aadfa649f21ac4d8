"""Fingerprints of documents from improbable features: rare byte windows, chained Bloom filters, normalised bit overlap.

Every byte window of a text has an entropy; the fewer windows of the whole corpus share its entropy level, the higher it
ranks. In every run of neighbouring windows the best ranked one gains a point, and windows with enough points are the text's
features. Features go, in text order, into Bloom filters of fixed size, a new one whenever one is full. Two fingerprints are
compared filter by filter: common bits beyond what chance gives, as a share of the most that could be common.

To set each document against the next one of the ascending order, rows are dealt into ranges of (id, hash of the text) and
read in order; the first row after a range is sent to that range, too.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

LEVELS = 1001
WEAK = 400  # levels below hold runs of few different bytes, which rank last
SHORT = 400  # code points below which a text is cut into short windows
WIDTHS = (32, 12)
FILTER_BYTES, FILTER_FEATURES, HASHES = 128, 80, 4
SAMPLED = 24
BLOCK = 1 << 16
PART_BYTES = 1 << 20
LONG = 1 << 20
PLACE_BITS = 21  # with a rank below 2**10 above them, keys fit 32 bits
LAST = (1 << 31) - 1


def _gains(width: int) -> np.ndarray:
    """How much c + 1 equal bytes add to the sum of c * log2 c, in units of 2^-20."""
    c = np.arange(width + 2, dtype=float)
    total = np.where(c > 0, c * np.log2(np.maximum(c, 1)), 0)
    return np.diff(np.round(total * (1 << 20)).astype(np.int64))


GAINS = {w: _gains(w) for w in WIDTHS}


def entropy_levels(x: np.ndarray, width: int) -> np.ndarray:
    """Level, 0 to 1000, of the entropy of every window of so many bytes.

    When a window moves on, its sum of c * log2 c changes by the counts of the byte that leaves and of the one that enters:
    how often they occur in the next, and the last, width - 1 places. A sorted list of (byte, place) answers both."""
    n, gain = len(x) - width + 1, GAINS[width]
    out = np.zeros(max(0, n), np.int16)
    whole = width * np.log2(width) * (1 << 20)
    for at in range(0, n, BLOCK):
        part = x[at : at + BLOCK + width - 1]
        order = np.argsort(part, kind="stable")
        keys = (part[order].astype(np.int32) << 17) | order.astype(np.int32)
        place = np.arange(len(part), dtype=np.int32)
        ahead, behind = np.empty(len(part), np.int32), np.empty(len(part), np.int32)
        ahead[order] = np.searchsorted(keys, keys + np.int32(width - 1), "right") - place - 1
        behind[order] = place - np.searchsorted(keys, np.maximum(keys - np.int32(width - 1), keys & ~np.int32((1 << 17) - 1)), "left")
        first = np.concatenate([[0], np.cumsum(gain)])[np.bincount(part[:width], minlength=256)].sum()
        sums = first + np.concatenate([[0], np.cumsum(gain[behind[width:]] - gain[ahead[: len(part) - width]])])
        out[at : at + len(sums)] = np.clip(np.round(1000 * (1 - sums / whole)), 0, 1000)
    return out


def windows_of(data: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array, where each starts, and the levels of all windows; those over two texts are -1."""
    size = np.array([len(d) for d in data], np.int64)
    start = np.concatenate([[0], np.cumsum(size)])
    x = np.frombuffer(b"".join(data), np.uint8)
    levels = np.full(len(x), -1, np.int16)
    levels[: max(0, len(x) - width + 1)] = entropy_levels(x, width)
    inside = np.zeros(len(x) + 1, np.int32)
    many = size >= width
    np.add.at(inside, start[:-1][many], 1)
    np.add.at(inside, start[1:][many] - width + 1, -1)
    levels[np.cumsum(inside[:-1]) == 0] = -1
    return x, start, levels


def feature_places(levels: np.ndarray, start: np.ndarray, rank: np.ndarray, width: int) -> np.ndarray:
    """Places of the windows that are the best ranked, the leftmost among equals, of `width` // 4 runs of `width` windows."""
    none, pad, n = np.int32(LAST), width - 1, len(levels)
    if len(start) == 2 and n > LONG + 2 * pad:  # a long text in pieces; a place depends on `pad` windows on either side
        out = []
        for at in range(0, n, LONG):
            low, high = max(0, at - pad), min(n, at + LONG + pad)
            found = low + feature_places(levels[low:high], np.array([0, high - low]), rank, width)
            out.append(found[(found >= at) & (found < at + LONG)])
        return np.concatenate(out)
    place = np.arange(n, dtype=np.int32)
    key = np.where(levels >= 0, (rank[levels] << PLACE_BITS) | place, none)
    keys = np.full(n + len(start) * pad, none, np.int32)  # texts lie apart, so that no run holds windows of two
    if len(start) == 2:
        keys[pad : pad + n] = key
    else:
        keys[place + np.repeat(np.arange(1, len(start), dtype=np.int32) * pad, np.diff(start))] = key
    best = C.sliding(keys, width, np.minimum)
    points = np.bincount(best[best != none] & ((1 << PLACE_BITS) - 1), minlength=n)
    return np.flatnonzero(points >= width // 4)


def window_hashes(x: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    rows = np.lib.stride_tricks.sliding_window_view(x, width)[places] if len(places) else np.zeros((0, width), np.uint8)
    h = np.full(len(places), np.uint64(width))
    for part in np.ascontiguousarray(rows).view(np.uint32).T:
        h = C.mix(h * C.C1 + part.astype(np.uint64))
    return h


class Print:
    """A fingerprint: number of features, and the filters they fill in turn."""

    __slots__ = ("n", "width", "filters", "bits")

    def __init__(self, n: int, width: int, filters: np.ndarray):
        self.n, self.width, self.filters = n, width, filters
        self.bits = np.bitwise_count(filters).sum(1, dtype=np.int64)

    @classmethod
    def of(cls, hashes: np.ndarray, width: int) -> Print:
        _, first = np.unique(hashes, return_index=True)
        h = hashes[np.sort(first)]
        filters = np.zeros((-(-len(h) // FILTER_FEATURES), FILTER_BYTES), np.uint8)
        which = np.arange(len(h)) // FILTER_FEATURES
        for k in range(HASHES):
            bit = ((h >> np.uint64(16 * k)) & np.uint64(8 * FILTER_BYTES - 1)).astype(np.int64)
            np.bitwise_or.at(filters, (which, bit >> 3), (1 << (bit & 7)).astype(np.uint8))
        return cls(len(h), width, filters.view(np.uint64))

    @classmethod
    def read(cls, s: str) -> Print:
        width, n, data = s.split(":")
        return cls(int(n), int(width), np.frombuffer(base64.b64decode(data), np.uint64).reshape(-1, FILTER_BYTES // 8))

    def __str__(self) -> str:
        return f"{self.width}:{self.n}:{base64.b64encode(self.filters.tobytes()).decode()}"

    def features(self) -> np.ndarray:
        return np.minimum(FILTER_FEATURES, self.n - FILTER_FEATURES * np.arange(len(self.filters)))


def likeness(a: Print, b: Print) -> float:
    """0 to 1: each filter of the shorter fingerprint against its best partner, weighted by its features.

    A pair's common bits count beyond chance (mean and deviation for random bits, wider the more partners there are)."""
    if a.width == b.width and a.n == b.n and np.array_equal(a.filters, b.filters):
        return 1.0
    if a.width != b.width or not a.n or not b.n:
        return 0.0
    if (len(b.filters), b.n) < (len(a.filters), a.n):
        a, b = b, a
    total, weights = 0.0, a.features()
    chances = 1 + np.sqrt(2 * np.log(len(b.filters)))
    step = max(1, (1 << 16) // len(b.filters))
    for at in range(0, len(a.filters), step):
        common = np.bitwise_count(a.filters[at : at + step, None, :] & b.filters[None]).sum(2, dtype=np.int64)
        x, y = a.bits[at : at + step, None], b.bits[None]
        share = y / (8 * FILTER_BYTES)
        most = np.minimum(x, y)
        chance = np.minimum(x * share + chances * np.sqrt(x * share * (1 - share)), most - 0.5)
        score = np.clip((common - chance) / (most - chance), 0, 1).max(1)
        total += float((score * weights[at : at + step]).sum())
    return total / a.n


def width_of(text: str) -> int:
    return WIDTHS[len(text) < SHORT]


def prints(texts: list[str], ranks: dict[int, np.ndarray], changed: list[tuple[int, bytes]] | None = None) -> tuple[list[Print], list[Print]]:
    """Fingerprints of texts, and of the texts with another end, given as (bytes kept, new end): most windows of these are known."""
    first: list = [None] * len(texts)
    second: list = [None] * len(texts)
    data = [C.encoded(t) for t in texts]
    for w in WIDTHS:
        for group in parts([k for k, t in enumerate(texts) if width_of(t) == w], data):
            x, start, levels = windows_of([data[k] for k in group], w)
            for k, p in zip(group, cut_prints(x, start, levels, ranks[w], w), strict=True):
                first[k] = p
            if changed:
                known = [max(0, changed[k][0] - w + 1) for k in group]
                ends = [data[k][p : changed[k][0]] + changed[k][1] for p, k in zip(known, group, strict=True)]
                _, tail, more = windows_of(ends, w)
                new = [data[k][:p] + e for k, p, e in zip(group, known, ends, strict=True)]
                both = np.concatenate([np.concatenate([levels[start[j] : start[j] + p], more[tail[j] : tail[j + 1]]]) for j, p in enumerate(known)])
                at = np.concatenate([[0], np.cumsum([len(d) for d in new])])
                for k, p in zip(group, cut_prints(np.frombuffer(b"".join(new), np.uint8), at, both, ranks[w], w), strict=True):
                    second[k] = p
    return first, second


def cut_prints(x: np.ndarray, start: np.ndarray, levels: np.ndarray, rank: np.ndarray, width: int) -> list[Print]:
    """A text without a whole window is one feature; an empty one has none."""
    places = feature_places(levels, start, rank, width)
    hashes, cuts, out = window_hashes(x, places, width), np.searchsorted(places, start), []
    for j in range(len(start) - 1):
        h = hashes[cuts[j] : cuts[j + 1]]
        if not len(h) and start[j] < start[j + 1]:
            h = np.array([xxhash.xxh3_64_intdigest(x[start[j] : start[j + 1]].tobytes())], np.uint64)
        out.append(Print.of(h, width))
    return out


def parts(which: list[int], data: list[bytes]) -> Iterator[list[int]]:
    group, size = [], 0
    for k in which:
        if group and size + len(data[k]) > PART_BYTES:
            yield group
            group, size = [], 0
        group.append(k)
        size += len(data[k])
    if group:
        yield group


COUNTED = "has_id boolean, doc_id long, h long, levels binary"


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document, and the number of windows of each level and width, on the first row of each batch."""
    for b in batches:
        texts = [t or "" for t in b["text"].to_pylist()]
        data = [C.encoded(t) for t in texts]
        counts = np.zeros((len(WIDTHS), LEVELS), np.int64)
        for i, w in enumerate(WIDTHS):
            for group in parts([k for k, t in enumerate(texts) if width_of(t) == w], data):
                levels = windows_of([data[k] for k in group], w)[2]
                counts[i] += np.bincount(levels[levels >= 0], minlength=LEVELS)
        ids = b["doc_id"]
        hashes = pa.array([xxhash.xxh3_64_intdigest(d) >> 1 for d in data], pa.int64())
        yield pa.record_batch([ids.is_valid(), ids.fill_null(0), hashes, pa.array([counts.tobytes()] + [None] * (len(texts) - 1), pa.binary())] if texts else [pa.array([], t) for t in (pa.bool_(), pa.int64(), pa.int64(), pa.binary())], ["has_id", "doc_id", "h", "levels"])


def rank_table(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, 0 the best: rare levels first, weak ones after all others."""
    order = sorted(range(LEVELS), key=lambda v: (v < WEAK, counts[v], v))
    out = np.zeros(LEVELS, np.int32)
    out[order] = np.arange(LEVELS)
    return out


def sum_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(len(WIDTHS) * LEVELS, np.int64)
    for b in batches:
        for x in b["levels"].to_pylist():
            total += np.frombuffer(x, np.int64)
    yield pa.record_batch([pa.array(np.arange(len(total)), pa.int64()), pa.array(total)], ["at", "n"])


def compared(held: list[list], ranks: dict[int, np.ndarray]) -> Iterator[tuple]:
    """Result rows of texts in order, each with its number of rows; the next text of the same range follows."""
    texts = [e[2] for e in held]
    ends = []
    for k, (cut, _, text, _) in enumerate(held):
        following = texts[k + 1] if k + 1 < len(held) and held[k + 1][0] == cut else text
        m = len(text) // 4
        ends.append((text[: len(text) - m], following, following[:m]))
    own, edited = prints(texts, ranks, [(len(C.encoded(a)), C.encoded(e)) for a, _, e in ends])
    for k, ((kept, following, end), (_, key, text, rows)) in enumerate(zip(ends, held, strict=True)):
        if not rows:
            continue
        new = kept + end
        changed = edited[k] if width_of(new) == width_of(text) else prints([new], ranks)[0][0]
        after = own[k + 1] if following is not text else own[k]
        row = (key[1] if key[0] else None, len(text), hashlib.sha256(C.encoded(new)).hexdigest(), str(own[k]), str(changed), likeness(own[k], changed), likeness(own[k], after))
        for _ in range(rows):
            yield row


def ranges(keys: DataFrame, n: int) -> tuple[list[tuple], list[tuple]]:
    """Bounds of n ranges, from a sample of fixed size, and for each range the smallest key after it (the last: the first).

    A key that stands for several bounds is dealt out to the ranges between them."""
    key = ["has_id", "doc_id", "h"]
    rows = keys.select(*key).orderBy(F.xxhash64(*key, F.monotonically_increasing_id())).limit(n * SAMPLED).collect()
    bounds = sorted(tuple(r) for r in rows)[SAMPLED - 1 :: SAMPLED][: n - 1]
    several = sorted({b for b, c in zip(bounds, bounds[1:]) if b == c})
    struct = F.struct(*key)
    after = [F.min(F.when(struct > F.struct(F.lit(b[0]).alias("has_id"), F.lit(b[1]).cast("long").alias("doc_id"), F.lit(b[2]).cast("long").alias("h")), struct)) for b in several]
    least, *rest = keys.agg(F.min(struct), *after).first()
    least = tuple(least) if least else None
    later = {b: tuple(r) if r else least for b, r in zip(several, rest, strict=True)}
    ahead = [later[b] if k and bounds[k - 1] == b else b for k, b in enumerate(bounds)] + [least]
    return bounds, ahead


PLACED = "cut int, own boolean, has_id boolean, doc_id long, h long, text string"
OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
OUT_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row for each row.

    The edited text is the text with its last quarter (code points, rounded down) replaced by as many first code points of
    the next document. Null texts are empty; the next document is that of the next greater (id, hash of the text), null ids
    first, and rows equal in both share it, so a table with one text has itself as the next. An empty text has no features:
    it is like other empty texts (1) and unlike all else (0). A text without a whole window is one feature. Extra columns are
    not read; an empty table gives no rows."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keys = C.stored(docs.mapInArrow(counted, COUNTED))
    levels = keys.where("levels is not null").select("levels").mapInArrow(sum_levels, "at long, n long").groupBy("at").agg(F.sum("n")).collect()
    counts = np.zeros(len(WIDTHS) * LEVELS, np.int64)
    for at, n in levels:
        counts[at] = n
    ranks = {w: rank_table(counts[i * LEVELS : (i + 1) * LEVELS]) for i, w in enumerate(WIDTHS)}
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, ahead = ranges(keys, n)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[tuple, list[int]] = {}
        for cut, key in enumerate(ahead):
            wanted.setdefault(key, []).append(cut)
        turn = 0
        for b in batches:
            rows = []
            for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                t = t or ""
                key = (i is not None, i or 0, xxhash.xxh3_64_intdigest(C.encoded(t)) >> 1)
                last = bisect.bisect_right(bounds, key)
                first = min(last, bisect.bisect_left(bounds, key) + 1)
                turn += 1
                rows.append((first + turn % (last - first + 1), True, *key, t))
                rows += [(cut, False, *key, t) for cut in wanted.pop(key, ())]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["cut", "own", "has_id", "doc_id", "h", "text"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []  # [range, key, text, rows]; the last may still get rows, and the one after it is not known
        size = 0

        def written(some: list[list]) -> Iterator[pa.RecordBatch]:
            rows = list(compared(some, ranks))
            for at in range(0, len(rows), 5000):
                columns = zip(*rows[at : at + 5000], strict=True)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, OUT.types, strict=True)], schema=OUT)

        for b in batches:
            for cut, own, has_id, i, h, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not held or held[-1][:2] != [cut, (has_id, i, h)]:
                    if size > PART_BYTES:
                        last, held[-1] = held[-1], [*held[-1][:3], 0]
                        yield from written(held)
                        held, size = [last], 0
                    held.append([cut, (has_id, i, h), text, 0])
                    size += len(text)
                held[-1][3] += own
        yield from written(held)

    dealt = docs.mapInArrow(place, PLACED).repartitionById(n, F.col("cut"))
    return dealt.sortWithinPartitions("cut", F.col("own").desc(), "has_id", "doc_id", "h").mapInArrow(compare, OUT_DDL)
