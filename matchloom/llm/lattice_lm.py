"""Language-model scores by subword lattice likelihood.

The subword vocabulary is an existing one and stays as it is. Its unigram scores are estimated from the training texts: how
often the vocabulary's own segmentation of their words uses each piece. A word's probability is the sum over all its
segmentations, by a forward recursion over its lattice in log space; a text's is the product over its words and the end.

Word counts are gathered by hash buckets, packed, one bucket at a time. For scoring every text shard asks the buckets for
its distinct words and gets counts and word probabilities back, so no task holds the corpus vocabulary.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MARK, END = "▁", -1
SHARD_BYTES, FEWEST = 16 << 20, 24
ANSWER = np.dtype([("c", "<i8"), ("p", "<f8")])
HELD_WORDS = 2_000_000
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def lowered(text) -> list[bytes]:
    return C.encoded(text).translate(UPPER).split()


def dealt(words, n: int) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for w in words:
        out.setdefault(xxhash.xxh3_64_intdigest(w) % n, []).append(w)
    return out


@lru_cache(maxsize=2)
def lattice_of(vocabulary: str, counts: tuple) -> Lattice:
    """One lattice for all groups that a worker process scores."""
    return Lattice(vocabulary, dict(counts))


class Lattice:
    """Log probabilities of the pieces, and of a word over all its segmentations."""

    def __init__(self, vocabulary: str, counts: dict[int, float], smoothing: float = 0.1):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        n = model.get_piece_size()
        total = math.log(sum(counts.values()) + smoothing * (n + 1))
        self.end = math.log(counts.get(END, 0.0) + smoothing) - total
        self.piece: dict[str, float] = {}
        self.byte = [0.0] * 256
        for k in range(n):
            p = math.log(counts.get(k, 0.0) + smoothing) - total
            if model.is_byte(k):
                self.byte[int(model.id_to_piece(k)[3:5], 16)] = p
            elif not (model.is_control(k) or model.is_unknown(k)):
                self.piece[model.id_to_piece(k)] = p
        self.beginnings = {t[:k] for t in self.piece for k in range(1, len(t) + 1)}

    def word(self, word: str) -> float:
        """Natural log of the probability of all ways to write the word; characters without a piece go by their bytes."""
        s = MARK + word
        n, piece, beginnings = len(s), self.piece, self.beginnings
        forward: list[float | None] = [None] * (n + 1)
        forward[0] = 0.0
        for i in range(n):
            at = forward[i]
            if at is None:
                continue
            j = i + 1
            sub = s[i:j]
            if sub not in piece:
                edges = [(j, sum(self.byte[b] for b in sub.encode("utf-8", "surrogatepass")))]
            else:
                edges = []
            while sub in beginnings:
                p = piece.get(sub)
                if p is not None:
                    edges.append((j, p))
                if j == n:
                    break
                j += 1
                sub = s[i:j]
            for k, p in edges:
                p += at
                old = forward[k]
                if old is None:
                    forward[k] = p
                elif old > p:
                    forward[k] = old + math.log1p(math.exp(p - old))
                else:
                    forward[k] = p + math.log1p(math.exp(old - p))
        return forward[n]


def word_counts(texts: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, words, counts), one row for each bucket: the counts of all words, packed. Words cannot contain line feeds."""
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count: Counter[bytes] = Counter()

        def flush() -> pd.DataFrame:
            parts = dealt(count, n_buckets)
            out = pd.DataFrame({"bucket": list(parts), "words": [b"\n".join(ws) for ws in parts.values()], "counts": [np.array([count[w] for w in ws], "<i8").tobytes() for ws in parts.values()]})
            count.clear()
            return out.astype({"bucket": "int32"})

        for pdf in batches:
            for text in pdf["text"]:
                count.update(lowered(text))
                if len(count) > HELD_WORDS:
                    yield flush()
        yield flush()

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total: Counter[bytes] = Counter()
        for ws, cs in zip(pdf["words"], pdf["counts"], strict=True):
            for w, c in zip(ws.split(b"\n"), np.frombuffer(cs, "<i8").tolist(), strict=True):
                total[w] += c
        return pd.DataFrame({"bucket": [key[0]], "words": [b"\n".join(total)], "counts": [np.array(list(total.values()), "<i8").tobytes()]})

    packed = "bucket int, words binary, counts binary"
    return texts.select("text").mapInPandas(send, packed).groupBy("bucket").applyInPandas(merge, packed)


def piece_counts(counts: DataFrame, vocabulary: str) -> dict[int, float]:
    """Uses of each piece in the vocabulary's segmentation of all counted words; as many rows as the vocabulary has pieces."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        total = np.zeros(model.get_piece_size())
        for pdf in batches:
            for ws, cs in zip(pdf["words"], pdf["counts"], strict=True):
                words, n = ws.split(b"\n"), np.frombuffer(cs, "<i8")
                for at in range(0, len(n), 10_000):
                    ids = model.encode([w.decode("utf-8", "replace") for w in words[at : at + 10_000]], num_threads=1)
                    sizes = [len(x) for x in ids]
                    total += np.bincount(np.fromiter((i for x in ids for i in x), np.int64, sum(sizes)), np.repeat(n[at : at + 10_000], sizes), len(total))
        used = np.flatnonzero(total)
        yield pd.DataFrame({"piece": used, "n": total[used]})

    return {r["piece"]: r["n"] for r in counts.select("words", "counts").mapInPandas(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()}


def lattice_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, folds: int = 7, held_fold: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each input row; logs of base 10.

    Null and empty texts are the end alone; a null id is not held out; repeated rows each count in training and get equal
    scores; without training rows all counts are 0; an empty table gives no rows; extra columns are not read."""
    vocabulary = vocabulary or default_vocabulary()
    size = C.total_bytes(df, text_col)
    n = max(FEWEST, min(C.MANY_SHARDS, -(-size // SHARD_BYTES)), -(-size // C.LARGE_SHARD_BYTES))
    n_buckets = max(32, n * 2)
    held = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == held_fold, F.lit(False))
    docs = df.select(F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n)).cast("int").alias("shard"), F.col(id_col).cast("long").alias("id"), held.alias("held"), F.col(text_col).cast("string").alias("text"))
    counts = C.stored(word_counts(docs.where(~F.col("held")), n_buckets))
    ends = docs.where(~F.col("held")).count()
    pieces = piece_counts(counts, vocabulary) | {END: float(ends)}

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            c = [np.frombuffer(x, "<i8") for x in pdf["counts"]]
            yield pd.DataFrame({"v": [int((x > 0).sum()) for x in c], "n": [int(x.sum()) for x in c]})

    v, tokens = counts.select("counts").mapInPandas(measure, "v long, n long").agg(F.sum("v"), F.sum("n")).first()
    v, tokens = (v or 0) + (ends > 0), (tokens or 0) + ends
    scores = tuple(pieces.items())
    end_base, end_p = math.log10((ends + 1) / (tokens + v + 1)), Lattice(vocabulary, pieces).end / math.log(10)
    by = docs.groupBy("shard")

    def ask(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        words: set[bytes] = set()
        for text in pdf["text"]:
            words.update(lowered(text))
        parts = dealt(words, n_buckets)
        return pd.DataFrame({"bucket": list(parts), "shard": key[0], "kind": 0, "data": [b"\n".join(sorted(ws)) for ws in parts.values()]}).astype({"bucket": "int32", "shard": "int32", "kind": "int32"})

    def answer(key: tuple, asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        count: dict[bytes, int] = {}
        for ws, cs in zip(known["words"], known["counts"], strict=True):
            count.update(zip(ws.split(b"\n"), np.frombuffer(cs, "<i8").tolist(), strict=True))
        lattice = lattice_of(vocabulary, scores)
        seen: dict[bytes, tuple[int, float]] = {}
        out = []
        for data in asked["data"]:
            ws = data.split(b"\n")
            for w in ws:
                if w not in seen:
                    seen[w] = (count.get(w, 0), lattice.word(w.decode("utf-8", "surrogatepass")))
            out.append(np.array([seen[w] for w in ws], ANSWER).tobytes())
        return pd.DataFrame({"shard": asked["shard"].to_numpy(), "kind": np.full(len(asked), key[0], np.int32), "data": out})

    def score(key: tuple, pdf: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        texts = [lowered(t) for t in pdf["text"]]
        words: set[bytes] = set()
        for ws in texts:
            words.update(ws)
        place: dict[bytes, int] = {}
        answers = dict(zip(back["kind"].tolist(), back["data"], strict=True))
        parts = dealt(words, n_buckets)
        table = [np.frombuffer(answers[b], ANSWER) for b in parts]
        for ws in parts.values():
            for w in sorted(ws):
                place[w] = len(place)
        table = np.concatenate(table) if table else np.zeros(0, ANSWER)
        room = tokens + v + 1
        base = np.log10((table["c"] + 1) / room)
        p = table["p"] / math.log(10)
        out = []
        for i, held_out, ws in zip(pdf["id"], pdf["held"], texts, strict=True):
            at = np.fromiter(map(place.__getitem__, ws), np.int64, len(ws))
            out.append((None if pd.isna(i) else int(i), bool(held_out), len(ws) + 1, int((table["c"][at] > 0).sum()) + int(ends > 0), tokens, float(base[at].sum()) + end_base, float(p[at].sum()) + end_p))
        return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"doc_id": "Int64"})

    asked = by.applyInPandas(ask, C.PACKED)
    back = asked.groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInPandas(answer, C.REPLY)
    return by.cogroup(back.groupBy("shard")).applyInPandas(score, RESULT)


