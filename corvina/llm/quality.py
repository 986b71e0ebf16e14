"""Quality by a generalised additive model with pairwise interactions.

A text becomes a few dozen figures; each figure's bins look up a learned table, the best pairs
of figures a two-way table, and the sum gives the score. The tables are learned by cyclic
boosting: round after round, every feature in turn gets a shallow tree on the
residuals, then every pair does.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvina.llm.labelled import fold, sample

#: Training rows at most: of label 0, of label 1.
SAMPLE = (6000, 6000)
FOLDS, HELD_OUT = 4, 2
FEATURES = (
    "log_chars", "log_words", "mean_word", "long_words", "short_words", "upper", "digits", "blanks", "marks", "odd_marks", "bars", "shouts", "beyond_ascii",
    "distinct_words", "top_word", "repeats", "longest_run", "lines", "mean_line", "repeated_lines", "stops", "capital_words", "marked_words", "deflate",
)


def features(text: str | None) -> list[float]:
    """The figures of a whole text, all 0 for a null, empty or blank one."""
    t = text or ""
    words = t.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, m = len(t), len(words)
    raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
    k = np.bincount(raw, minlength=256)
    letters = max(1, k[65:91].sum() + k[97:123].sum() + k[128:].sum())
    marks = k[33:48].sum() + k[58:65].sum() + k[91:97].sum() + k[123:127].sum()
    lengths = np.fromiter(map(len, words), np.int64, m)
    _, code, count = np.unique(np.fromiter(map(hash, words), np.int64, m), return_inverse=True, return_counts=True)
    same = code[1:] == code[:-1]
    edges = np.flatnonzero(np.r_[True, ~same, True])
    lines = [x for x in t.split("\n") if x.strip()]
    return [
        np.log1p(n), np.log1p(m), lengths.mean(), (lengths > 14).mean(), (lengths < 3).mean(),
        k[65:91].sum() / letters, k[48:58].sum() / n, (k[9:14].sum() + k[32]) / n, marks / n,
        sum(int(k[ord(c)]) for c in "#$%&*@^~<>{}[]=+\\|") / n, k[124] / n, k[33] / n, k[128:].sum() / len(raw),
        len(count) / m, count.max() / m, same.mean() if m > 1 else 0.0, np.diff(edges).max() / m,
        np.log1p(len(lines)), np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines),
        (k[46] + k[63]) / m, sum(map(str.isupper, words)) / m, len(re.findall(r"[#$%&*]{2,}", t)) / m, len(zlib.compress(t.encode("utf-8", "surrogatepass"), 1)) / len(raw),
    ]


@dataclass
class Additive:
    """The learned model: cuts per feature, tables per feature, tables per pair of features."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(self.cuts)]) if len(x) else np.zeros((0, len(self.cuts)), np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for i, t in enumerate(self.tables):
            z += t[b[:, i]]
        for (i, j), t in self.pairs.items():
            z += t[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut of bins in two; place 0 if none gains."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gain = gl**2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    k = int(np.argmax(gain))
    return (float(gain[k]), k + 1) if gain[k] > 1e-9 else (0.0, 0)


def _step(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """A tree of up to three leaves over ordered bins: the step of each bin."""
    _, at = _best_cut(g, h, ridge)
    parts = [(0, at), (at, len(g))] if at else [(0, len(g))]
    best = max(((*_best_cut(g[a:b], h[a:b], ridge), a, b) for a, b in parts), key=lambda x: x[0])
    if best[1]:
        parts = sorted([p for p in parts if p != best[2:]] + [(best[2], best[2] + best[1]), (best[2] + best[1], best[3])])
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _pair_step(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and steps of a tree that cuts one side of a two-way table, then each part along the other."""
    best, out = 0.0, np.zeros_like(g)
    for turn in (False, True):
        a, b = (g.T, h.T) if turn else (g, h)
        for at in range(1, len(a)):
            gain, step = 0.0, np.zeros_like(a)
            for part in (slice(0, at), slice(at, None)):
                gs, hs = a[part].sum(0), b[part].sum(0)
                gain_cut, k = _best_cut(gs, hs, ridge)
                gain += gain_cut + gs.sum() ** 2 / (hs.sum() + ridge)
                step[part, :k] = gs[:k].sum() / (hs[:k].sum() + ridge) if k else 0.0
                step[part, k:] = gs[k:].sum() / (hs[k:].sum() + ridge)
            if gain > best:
                best, out = gain, step.T if turn else step
    return best - g.sum() ** 2 / (h.sum() + ridge), out


def learn(x: np.ndarray, y: np.ndarray, *, bins: int = 32, rounds: int = 120, pair_rounds: int = 20, n_pairs: int = 6, rate: float = 0.15, ridge: float = 2.0) -> Additive:
    """The model of rows ``x`` with labels ``y``; with one class or no rows, the classes' share alone."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0) for c in (x.T if len(x) else np.empty((len(FEATURES), 0)))]
    model = Additive(base, cuts, [np.zeros(len(c) + 1) for c in cuts], {})
    if len(np.unique(y)) < 2:
        return model
    b = model.bins(x)
    z = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i, t in enumerate(model.tables):
            g, h = slopes()
            step = rate * _step(np.bincount(b[:, i], g, len(t)), np.bincount(b[:, i], h, len(t)), ridge)
            t += step
            z += step[b[:, i]]
    coarse = [np.minimum(np.arange(len(t)) * 8 // len(t), 7) for t in model.tables]
    g, h = slopes()

    def grid(i: int, j: int, w: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[i][b[:, i]] * 8 + coarse[j][b[:, j]], w, 64).reshape(8, 8)

    gains = sorted(((_pair_step(grid(i, j, g), grid(i, j, h), ridge)[0], i, j) for i in range(len(cuts)) for j in range(i)), reverse=True)
    chosen = [(i, j) for gain, i, j in gains[:n_pairs] if gain > 0]
    small = {p: np.zeros((8, 8)) for p in chosen}
    for _ in range(pair_rounds):
        for i, j in chosen:
            g, h = slopes()
            step = rate * _pair_step(grid(i, j, g), grid(i, j, h), ridge)[1]
            small[i, j] += step
            z += step[coarse[i][b[:, i]], coarse[j][b[:, j]]]
    model.pairs = {(i, j): t[np.ix_(coarse[i], coarse[j])] for (i, j), t in small.items()}
    return model


def _figures(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with an array column of the figures in place of the text."""
    at = docs.columns.index(text_col)
    fields = [f for f in docs.schema.fields if f.name != text_col]
    names = [f.name for f in fields] + ["__x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([features(t) for t in batch.column(at).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), x], names)

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("__x", T.ArrayType(T.DoubleType()))]))


def train(docs: DataFrame, labels: DataFrame, *, per_class: tuple[int, int] = SAMPLE, folds: int = FOLDS, held_out: int = HELD_OUT, label: str = "quality", **cols) -> Additive:
    """A model from the labelled rows outside the held-out fold, at most ``per_class`` of each label."""
    rows = sample(docs, labels, label, folds=folds, held_out=held_out, per_class=per_class, **cols)
    got = _figures(rows, "text").select("y", "__x").collect()  # at most sum(per_class) rows of figures
    got.sort(key=lambda r: (r["y"], r["__x"]))
    return learn(np.array([r["__x"] for r in got], float).reshape(len(got), len(FEATURES)), np.array([r["y"] for r in got], float))


def score(docs: DataFrame, model: Additive, *, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double column ``name`` between 0 and 1 from the whole text; null counts as empty, another column of that name is replaced."""
    docs = docs if name == text_col else docs.drop(name)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in batch.column(at).to_pylist()], float).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x), pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it is held out, its quality and the decision at 0.7."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = score(docs.select("doc_id", "text"), train(docs, labels))
    return found.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {"op10_quality": op10_quality}
ORACLES: dict[str, str] = {}
