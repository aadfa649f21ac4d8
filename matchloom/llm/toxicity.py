"""Toxicity by a weighted lexicon, matched with Aho-Corasick in folded text and normalised by length.

Folding lower-cases and maps look-alike letters, accents, digits and symbols that stand for letters to one letter each, in the
texts and in the lexicon. An entry is a whole word ("word>"), a stem that more letters follow ("stem+"), or either ("stem"); its
weight is the log-odds of toxic to clean documents that hold it. Hits inside an exception phrase do not count. The weights' sum, alone and per thousand words, goes through a logistic
curve. Weights and curve are fitted on a sample bounded by `sample` documents a class; scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

# Letters and digits that look like a Latin letter.
LOOK_ALIKES = {
    "a": "4@аαàáâãäåā", "b": "8вβ", "c": "сϲçćč", "d": "ԁ", "e": "3еєεèéêëēė", "g": "9ɡ", "h": "һн", "i": "1lіιìíîïī|", "j": "ј", "k": "кκ", "m": "м", "n": "пñń",
    "o": "0оοòóôõöøō", "p": "рρ", "s": "5$ѕśš", "t": "7тτ", "u": "υùúûüū", "v": "ѵν", "w": "ѡω", "x": "хχ", "y": "уγýÿ", "z": "2žźż",
}
INVISIBLE = "​‌‍⁠﻿­"
# Insults that count unless clean documents hold them; labels refine their weights and add others.
INSULTS = ("idiot", "moron", "imbecile", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "vermin", "filth", "clown", "bastard", "scumbag", "dumbass", "asshole", "bitch", "fuck", "whore")
INSULT_WEIGHT = 3.0
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "pond scum", "lose weight", "moronic acid")
WORD = re.compile(r"[^\W\d_]+")
# A symbol, all symbols, digits and invisible characters after it, and the letter they lead to, if any.
SYMBOL = re.compile(rf"[@$|][@$|\d{INVISIBLE}]*+([^\W\d_])?")
BLANK = dict.fromkeys(map(ord, "@$|"), " ")


def fold_table() -> dict[int, str | None]:
    t: dict[int, str | None] = {ord(c): latin for latin, cs in LOOK_ALIKES.items() for c in cs}
    t |= {0xFF41 + k: t.get(97 + k, chr(97 + k)) for k in range(26)}  # full-width letters
    return t | dict.fromkeys(map(ord, INVISIBLE))


FOLD = fold_table()


def fold(text) -> str:
    if not isinstance(text, str):
        return ""
    s = text.lower()
    if "$" in s or "@" in s or "|" in s:
        s = SYMBOL.sub(lambda m: m[0] if m[1] else m[0].translate(BLANK), s)  # at a word's end it is no letter
    return s.translate(FOLD)


@dataclass
class Model:
    """Lexicon entry (folded) -> weight, exception phrases, and the curve's coefficients."""

    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-6.0, 3.0, 1.0)

    def matcher(self) -> ahocorasick.Automaton | None:
        if not self.lexicon:
            return None
        found: dict[str, list] = {}
        for term, weight in self.lexicon.items():
            found.setdefault(term.rstrip(">+"), []).append((term[-1] != "+", term[-1] != ">", weight))
        machine = ahocorasick.Automaton()
        phrases = {fold(x) for x in self.exceptions} - {""}
        for key in phrases | set(found):
            machine.add_word(key, (len(key), key in phrases, tuple(found.get(key, ()))))
        machine.make_automaton()
        return machine


def weighted_hits(machine, text: str) -> float:
    """Sum of the weights of what stands at word beginnings outside exception phrases; the longest entry of a word counts."""
    if machine is None or not text:
        return 0.0
    spared, best, n = [], {}, len(text)
    for end, (length, is_phrase, entries) in machine.iter(text):
        start = end + 1 - length
        if start and text[start - 1].isalpha():
            continue
        ends = end + 1 == n or not text[end + 1].isalpha()
        if is_phrase and ends:
            spared.append((start, end))
        for at_end, before_more, weight in entries:
            if at_end if ends else before_more:
                best[start] = max(best.get(start, weight), weight)
    if spared:
        return sum(w for s, w in best.items() if not any(a <= s <= b for a, b in spared))
    return sum(best.values())


def features(total: float, text: str) -> tuple[float, float]:
    return math.log1p(total), math.log1p(1000.0 * total / (text.count(" ") + text.count("\n") + 20))


def score_column(text: Column, model: Model) -> Column:
    """Score 0 to 1 of a text column."""
    a, b, c = model.curve

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = model.matcher()
        for texts in batches:
            out = []
            for raw in texts:
                s = fold(raw)
                x, y = features(weighted_hits(machine, s), s)
                out.append(1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, a + b * x + c * y)))))
            yield pd.Series(out, dtype="float64")

    return score(text)


def held_out(doc_id: str, folds: int = 5, fold_no: int = 0) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == fold_no, F.lit(False))


def beginnings(text: str) -> set[str]:
    """Entries of all words in a folded text: stems of 3 to 12 letters that more follow, and whole words."""
    out = set()
    for w in set(WORD.findall(text)):
        out.update(w[:k] + "+" for k in range(3, min(len(w) - 1, 12) + 1))
        if len(w) > 2:
            out.add(w + ">")
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic: str = "toxic", sample: int = 6000, share: float = 0.01) -> Model:
    """Lexicon and curve from labelled rows; at most `sample` documents a class, those with the smallest hash of their id.

    An entry must stand in `share` of the toxic documents (five at least), copies of a text counted once, and be significantly
    more frequent there than in clean ones. Where the labels of an id, or of copies of a text, disagree, it counts as toxic.
    Insults of the fixed list come in unless clean documents hold them; without toxic or clean rows the lexicon is that list,
    with the default curve."""
    lab = labels.select(F.col(id_col).alias("id"), F.col(toxic).cast("int").alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    n = {r["y"]: r["count"] for r in lab.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model({fold(w): INSULT_WEIGHT for w in INSULTS})
    chosen = lab.where("y = 1").orderBy(F.xxhash64("id"), "id").limit(sample).union(lab.where("y = 0").orderBy(F.xxhash64("id"), "id").limit(sample))
    # at most 2 * sample rows of two numbers, whatever the input
    rows = C.stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").groupBy(F.md5("text").alias("m")).agg(F.first("text").alias("text"), F.max("y").alias("y")).select("text", "y").repartition(24))
    size = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    least = max(5, math.ceil(share * n1))

    def count(only: set[str] | None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            c: Counter[str] = Counter()
            for pdf in batches:
                for t in pdf["text"]:
                    found = beginnings(fold(t))
                    c.update(found if only is None else found & only)
            yield pd.DataFrame({"term": list(c), "n": list(c.values())}).astype({"term": "object", "n": "int64"})

        return run

    c1 = {r["term"]: r["n"] for r in rows.where("y = 1").select("text").mapInPandas(count(None), "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).collect()}
    insults = {fold(w) for w in INSULTS}
    asked = set(c1) | {t[:-1] + "+" for t in c1} | {f"{w}>" for w in insults}
    c0 = {r["term"]: r["n"] for r in rows.where("y = 0").select("text").mapInPandas(count(asked), "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    weight = {t: math.log((c + 0.5) / (n1 + 1)) - math.log((c0.get(t, 0) + 0.5) / (n0 + 1)) for t, c in c1.items()}
    expected = {t: c0.get(t, 0) * n1 / max(n0, 1) for t in c1}
    model = Model(chosen_terms(c1, c0, weight, {t: (c - expected[t]) / math.sqrt(expected[t] + 1) for t, c in c1.items()}))
    model.lexicon |= {w: INSULT_WEIGHT for w in insults if w not in model.lexicon and f"{w}>" not in model.lexicon and f"{w}>" not in c0}

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = model.matcher()
        for pdf in batches:
            f = [features(weighted_hits(machine, s), s) for s in map(fold, pdf["text"])]
            yield pd.DataFrame({"x": [a for a, _ in f], "z": [b for _, b in f], "y": pdf["y"]})

    points = np.array(rows.mapInPandas(measure, "x double, z double, y int").collect(), float).reshape(-1, 3)
    points = points[np.lexsort(points.T)]
    model.curve = logistic(points, np.where(points[:, 2] == 1, n[1] / max(n1, 1), n[0] / max(n0, 1)))
    return model


def chosen_terms(count: dict[str, int], clean: dict[str, int], weight: dict[str, float], score: dict[str, float], least: float = 1.2, least_score: float = 6.0) -> dict[str, float]:
    """Entries of enough weight and significance that do not repeat each other: of stems and words that extend each other
    the longest that still has nine tenths of the hits, then the shortest left. A word of five letters or more whose longer
    forms never stand in clean documents counts with any ending."""
    good = {t for t in count if weight[t] >= least and score[t] >= least_score}
    longer: dict[str, int] = {}
    for t in good:
        longer[t[:-2]] = max(longer.get(t[:-2], 0), count[t])
        for k in range(3, len(t) - 1):  # a much clearer entry that has most of a stem's hits stands for it
            stem = f"{t[:k]}+"
            if stem in count and weight[t] >= weight[stem] + 1 and count[t] >= 0.6 * count[stem]:
                longer[t[:k]] = count[stem]
    kept: set[str] = set()
    for t in sorted((t[:-1] for t in good if t[-1] == "+"), key=len):
        if longer.get(t, 0) < 0.9 * count[t + "+"] and not any(t[:k] in kept for k in range(3, len(t))):
            kept.add(t)
    out = {f"{t}+": weight[f"{t}+"] for t in kept}
    for t in good:
        w = t[:-1]
        if t[-1] == ">" and not any(w[:k] in kept for k in range(3, len(w))):
            out[w if len(w) >= 5 and w not in kept and f"{w}+" not in clean else t] = weight[t]
    return out


def logistic(points: np.ndarray, w: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Newton steps on (x, z, y) rows with weights."""
    if not len(points):
        return (-40.0, 0.0, 0.0)
    x, y = np.column_stack([np.ones(len(points)), points[:, :2]]), points[:, 2]
    w = w * len(w) / w.sum()
    b = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        grad = x.T @ (w * (y - p)) - ridge * np.array([0, 1, 1]) * b
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, ridge, ridge])
        step = np.linalg.solve(hess, grad)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1]), float(b[2])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, sample: int = 6000) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each input row; learns only from rows outside the held-out fold.

    Null and empty texts have no hits, so they get the score of a text without any; null ids are not held out and have no
    label; repeated rows get equal scores; an empty table gives no rows; of extra columns nothing is read."""
    model = fit(docs, labels.where(~held_out(id_col, folds)), id_col, text_col, sample=sample)
    out = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col, folds).alias("held_out"), score_column(F.col(text_col).cast("string"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
