"""Packing of tokenized documents into sequences by the sum-of-squares rule.

Tokenizing runs where the rows are, and only small rows (a piece's place and length) go on. Pieces are dealt evenly to groups
of some ten thousand, whatever their documents; each group is packed alone, largest pieces first. A group leaves a few open
sequences, far below a thousandth of what it fills.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

GROUP = 32_768
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Fixed value: how the vocabulary's file splits lower-cased text before merging.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PLAIN = regex.compile(r"[\x21-\x7E\u00A1-\u012F\u0131-\u024F]+")


class Tokens(dict):
    """Little-endian 32-bit ids of each run of non-space bytes. White space ends every token, so a text's ids are those of
    its runs; and in runs of Latin letters and signs, which normalising leaves alone, those of the parts that the vocabulary
    merges apart. A full cache keeps its older half, which holds the frequent entries; long runs are not kept."""

    def __init__(self, vocabulary: str, most: int = 1_500_000):
        from tokenizers import Tokenizer

        self.most, self.tokenizer = most, Tokenizer.from_file(vocabulary)
        words = self.tokenizer.get_vocab()
        self.last = np.zeros(max(words.values()) + 1, bool)  # ids that end a part
        self.last[[i for t, i in words.items() if t.endswith("</w>")]] = True

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, runs: set[bytes]) -> None:
        """Splits each new run once into its parts, encodes many together, which is faster than one by one, and keeps the ids."""
        if len(self) + len(runs) > self.most:
            for run in list(self)[self.most // 2 :]:
                del self[run]
        split: list[tuple[bytes, list[str]]] = []
        for run in runs:
            text = run.decode("utf-8")
            if self.plain(run, text) and (parts := PIECES.findall(text.lower())):
                split.append((run, parts))
        for at in range(0, len(split), 1000):
            some = split[at : at + 1000]
            ids = np.array(self.tokenizer.encode(" ".join([p for _, ps in some for p in ps]), add_special_tokens=False).ids, "<u4")
            ends, upto = np.flatnonzero(self.last[ids]) + 1, np.cumsum([len(ps) for _, ps in some])
            if len(ends) == upto[-1]:
                data, before = ids.tobytes(), 0
                for (run, _), end in zip(some, (4 * ends[upto - 1]).tolist(), strict=True):
                    self[run] = data[before:end]
                    before = end

    @staticmethod
    def plain(run: bytes, text: str) -> bool:
        return len(run) <= 64 and "<|" not in text and PLAIN.fullmatch(text) is not None

    def __missing__(self, run: bytes) -> bytes:
        text = run.decode("utf-8")
        ids = b"".join([self.encode(p) for p in PIECES.findall(text.lower())]) if self.plain(run, text) else self.encode(text)
        if len(run) <= 64:
            self[run] = ids
        return ids

    def of_all(self, texts) -> Iterator[bytes]:
        for at in range(0, len(texts), 200):
            split = [C.words(t) for t in texts[at : at + 200]]
            self.learn({w for ws in split for w in ws if w not in self})
            for ws in split:
                yield b"".join(map(self.__getitem__, ws))

    def of(self, text) -> bytes:
        return next(self.of_all([text]))


@lru_cache(maxsize=2)
def tokens_of(vocabulary: str) -> Tokens:
    """One for all tasks of a worker process."""
    return Tokens(vocabulary)


def pieces(df: DataFrame, id_col: str, text_col: str, vocabulary: str, limit: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut only where longer than `limit`."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = tokens_of(vocabulary)
        for pdf in batches:
            out = []
            for i, ids in zip(pdf["id"], tokens.of_all(pdf["text"].tolist()), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    cut = ids[at : at + 4 * limit]
                    out.append((None if pd.isna(i) else int(i), k, at // 4, len(cut) // 4, zlib.crc32(cut)))
            x = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            x["doc_id"] = x["doc_id"].astype("Int64")
            yield x

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInPandas(run, PIECE)


def sum_of_squares(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of every piece, in the given order, and the number of sequences.

    A piece goes where the sum over residual gaps of (open sequences with that gap) squared becomes smallest: into an open
    sequence of some gap, or a new one. Closed sequences do not count; among equal sums the smallest gap wins."""
    count = np.zeros(limit + 1, np.int64)
    opened: list[list[int]] = [[] for _ in range(limit + 1)]
    sequence, offset, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for k, s in enumerate(lengths.tolist()):
        gaps = np.flatnonzero(count[s:]) + s
        rest = limit - s
        change = 2 * count[rest] + 1 if rest else 0
        gap = 0
        if len(gaps):
            change_to = np.where(gaps > s, 2 * count[gaps - s] + 1, 0) - 2 * count[gaps] + 1
            best = int(change_to.argmin())
            if change_to[best] <= change:
                gap = int(gaps[best])
        if gap:
            at = opened[gap].pop()
            count[gap] -= 1
        else:
            at, gap, n = n, limit, n + 1
        sequence[k], offset[k] = at, limit - gap
        if gap > s:
            opened[gap - s].append(at)
            count[gap - s] += 1
    return sequence, offset, n


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = 2048, end_id: int = 0, group: int = GROUP) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row for each piece of each row.

    Null and empty texts are one piece with the end id alone; null ids stay null; repeated rows are packed each for itself;
    extra columns are not read; an empty table gives no rows. The pieces are stored first, so that dealing them out by row
    number gives the same groups if a task runs again."""
    cut = C.stored(pieces(df, id_col, text_col, vocabulary or default_vocabulary(), limit, end_id))
    n = max(1, round(cut.count() / group))
    dealt = cut.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        sequence, offset, _ = sum_of_squares(pdf["length"].to_numpy(np.int64), limit)
        return pdf.drop(columns="grp").assign(sequence_id=(np.int64(key[0]) << 32) + sequence, offset=offset)

    return dealt.groupBy("grp").applyInPandas(run, PIECE + ", sequence_id long, offset long")
