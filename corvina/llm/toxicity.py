"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton.

Texts are folded (case, look-alike letters, digits and signs put for letters), reduced to
words and searched for the lexicon's words and word beginnings; words inside an exception
phrase don't count. The weights found, by themselves and per length, give the score.
Lexicon, weights and calibration are learned from a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvina.llm.common import shielded
from corvina.llm.labelled import fold, sample

#: Training rows at most: of label 0, of label 1.
SAMPLE = (5000, 2500)
FOLDS, HELD_OUT = 3, 1
#: Look-alike letters and the Latin letters they stand for.
HOMOGLYPHS = str.maketrans("аеорсухіјѕԁһкмтвнαοερνικτυ", "aeopcyxijsdhkmtbhaoepvikty")
#: Digits and signs put for letters inside a word.
SIGNS = str.maketrans("013457@$!", "oieastasi")
#: Harmless phrases around words that are often abusive.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clown nose", "class clown", "pond scum", "soap scum")
#: Used where there is no training row.
DEFAULT_LEXICON = {" idiot ": 4.0, " moron ": 4.0, " loser ": 4.0, " scum ": 4.0, " stupid ": 3.0, " worthless ": 3.0, " pathetic ": 3.0, " disgusting ": 3.0}


def fold_text(text: str | None) -> str:
    """The words of the text, folded, each with a space around it."""
    t = (text or "").lower().translate(HOMOGLYPHS)
    if re.search(r"[^\W_][\d@$!]|[\d@$!][^\W_]", t):
        t = re.sub(r"[^\W_]*(?:\d|(?<=[^\W_])[@$!](?=[^\W_]))(?:[^\W_]|[@$!](?=[^\W_]))*", lambda m: m[0].translate(SIGNS) if 3 * sum(c.isalpha() for c in m[0]) > len(m[0]) else m[0], t)
    return f" {re.sub(r'[\W_]+', ' ', t).strip()} "


@dataclass
class Lexicon:
    """Weighted patterns: " word " for a word, " begin" for words that begin so."""

    weights: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_LEXICON))
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: Intercept and factors of the log weight and the log weight per 1,000 characters.
    calibration: tuple[float, float, float] = (-4.0, 2.0, 1.0)

    def matcher(self):
        """A function from folded text to the weight of what it holds."""
        import ahocorasick

        machine = ahocorasick.Automaton()
        for p, w in self.weights.items():
            machine.add_word(p, (len(p), w))
        for p in self.exceptions:
            machine.add_word(f" {p} ", (len(p) + 2, None))
        if len(machine) == 0:
            return lambda text: 0.0
        machine.make_automaton()

        def weigh(text: str) -> float:
            found: dict[int, float] = {}
            spared = []
            for end, (n, w) in machine.iter(text):
                at = end - n + 1
                if w is None:
                    spared.append((at, end))
                else:
                    found[at] = max(found.get(at, 0.0), w)
            return sum(w for at, w in found.items() if not any(a <= at < b for a, b in spared))

        return weigh

    def score(self, weight: np.ndarray, length: np.ndarray) -> np.ndarray:
        z = np.c_[np.ones(len(weight)), _features(weight, length)] @ np.array(self.calibration)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _features(weight: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.c_[np.log1p(weight), np.log1p(1000 * weight / np.maximum(length, 200))]


def _units(words: Iterable[str]) -> set[str]:
    out = set()
    for w in words:
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in range(4, min(8, len(w) - 1) + 1))
    return out


def learn(rows: Iterable[tuple[str | None, int]], *, most: int = 400, cover: int = 4) -> Lexicon:
    """A lexicon and its calibration from (text, label) rows; too few rows give the default one."""
    texts = {0: [], 1: []}
    heads: set[tuple[int, int]] = set()
    for text, y in rows:
        folded = fold_text(text)
        words = folded.split()
        # Near copies share the smallest hash of their word triples nearly always, other texts hardly ever; one of them teaches.
        head = (y, min((zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))), default=0))
        if head not in heads:
            heads.add(head)
            texts[y].append(folded)
    bad, good = texts[1], texts[0]
    if len(bad) < 10 or len(good) < 10:
        return Lexicon()
    least = max(3, len(bad) // 250)
    seen = Counter()
    for t in bad:
        seen.update(_units(set(t.split())))
    odd = {u for u, n in seen.items() if n >= least}
    clean = Counter()
    for t in good:
        clean.update(_units(set(t.split())) & odd)
    rare = {u for u in odd if (clean[u] + 0.5) / len(good) < 0.04 * seen[u] / len(bad)}
    where: dict[str, list[int]] = {}
    for i, t in enumerate(bad):
        for u in _units(set(t.split())) & rare:
            where.setdefault(u, []).append(i)
    open_ = np.full(len(bad), cover)
    weights: dict[str, float] = {}
    while where and len(weights) < most:
        gains = {u: int(np.count_nonzero(open_[d] > 0)) for u, d in where.items()}
        where = {u: d for u, d in where.items() if gains[u] >= least}
        if not where:
            break
        u = max(where, key=lambda u: (gains[u], -clean[u], len(u), u))
        a, b = seen[u], clean[u]
        weights[u] = math.log((a + 0.5) / (len(bad) - a + 0.5)) - math.log((b + 0.5) / (len(good) - b + 0.5))
        open_[where.pop(u)] -= 1
        # Shorter and longer beginnings of the same words say nothing more.
        where = {v: d for v, d in where.items() if not (v.startswith(u) or u.startswith(v.rstrip()) and not v.endswith(" "))}
    weights = {u: w for u, w in weights.items() if w > 0}
    out = Lexicon(weights or dict(DEFAULT_LEXICON))
    weigh = out.matcher()
    both = bad + good
    x = np.c_[np.ones(len(both)), _features(np.array([weigh(t) for t in both]), np.array([len(t) for t in both]))]
    y = np.r_[np.ones(len(bad)), np.zeros(len(good))]
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-2, 1e-2])
        beta = beta + np.linalg.solve(h, x.T @ (y - p) - np.array([1e-3, 1e-2, 1e-2]) * beta)
    out.calibration = tuple(float(b) for b in beta)
    return out


def train(docs: DataFrame, labels: DataFrame, *, per_class: tuple[int, int] = SAMPLE, folds: int = FOLDS, held_out: int = HELD_OUT, label: str = "toxic", **cols) -> Lexicon:
    """A lexicon from the labelled rows outside the held-out fold, at most ``per_class`` of each label."""
    rows = sample(docs, labels, label, folds=folds, held_out=held_out, per_class=per_class, **cols)
    # In the same order however the rows are stored: sums of floats follow it.
    return learn((r["text"], r["y"]) for r in rows.orderBy("y", F.xxhash64("text"), "text").toLocalIterator())


def score(docs: DataFrame, lexicon: Lexicon, *, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double column ``name`` between 0 and 1, from the whole text; null and empty texts get the lowest score.

    Another column of that name is replaced.
    """
    docs = docs if name == text_col else docs.drop(name)
    kept = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = lexicon.matcher()
        for batch in batches:
            texts = [fold_text(t) for t in batch.column(at).to_pylist()]
            s = lexicon.score(np.array([weigh(t) for t in texts], float), np.array([len(t) for t in texts], float))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, kept)


def reject_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns as they are."""
    lexicon = train(docs, labels, text_col=text_col, **how)
    inner, (text_,) = shielded(docs, text_col)
    return score(inner, lexicon, text_col=text_, name="toxicity").where(F.col("toxicity") < threshold).drop("toxicity").toDF(*docs.columns)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it is held out, its toxicity and the decision at 0.7."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = score(docs.select("doc_id", "text"), train(docs, labels))
    return found.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLES: dict[str, str] = {}
