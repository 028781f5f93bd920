"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes
log-count ratios.

Features are character n-grams (3 to 6 characters of the lower-cased text in
which every run of other characters is one blank, so n-grams know where words
begin and end), hashed to ``BUCKETS`` cells; a feature is present or not. From
the labelled sample each cell has the log ratio of its smoothed presence in
toxic and other texts. The ``FEATURES`` cells with the most telling ratios
enter a logistic regression whose inputs are those ratios.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import labelled
from tidelog.llm.common import Kept, lean, small_batches, stored

BUCKETS = 1 << 20
SIZES = (3, 4, 5, 6)
FEATURES = 2048
# At most so many labelled rows are learnt from (features: 256 bytes a row).
MAX_SAMPLE_ROWS = 20_000
MIN_SUPPORT = 3
STEPS, RATE, RIDGE = 250, 0.02, 1e-4
# Whole texts are hashed in pieces of so many characters (overlapping by an n-gram).
PIECE = 1 << 20
# Counted cells leave a worker in batches of so many rows: what a worker takes once it keeps.
CELLS_PER_BATCH = 1 << 16

_GAP = re.compile(r"[\W_]+")


def grams(text: str) -> Iterator[np.ndarray]:
    """Cells of all n-grams of ``text``, piece by piece."""
    clean = " " + _GAP.sub(" ", text.lower()).strip() + " "
    for start in range(0, len(clean), PIECE):
        code = np.frombuffer(clean[start:start + PIECE + max(SIZES) - 1].encode("utf-32-le", "surrogatepass"),
                             dtype=np.uint32)
        rolling = code
        for n in range(2, max(SIZES) + 1):
            if len(code) < n:
                break
            rolling = rolling[:len(code) - n + 1] * np.uint32(16777619) ^ code[n - 1:] * np.uint32(2654435761)
            if n in SIZES:
                mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(2246822507 + 2 * n)
                yield (mixed ^ (mixed >> np.uint32(13))) & np.uint32(BUCKETS - 1)


def present(text: str, slots: np.ndarray) -> np.ndarray:
    """Distinct features of ``text``; ``slots`` maps a cell to its feature or -1."""
    hits = [s[s >= 0] for s in (slots[g] for g in grams(text))]
    return np.unique(np.concatenate(hits)) if hits else np.zeros(0, dtype=np.int64)


@dataclass
class Model:
    slots: np.ndarray   # cell -> feature or -1
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + (float(self.weights[present(text, self.slots)].sum()) if text else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def presence_counts(sample: DataFrame) -> DataFrame:
    """``cell``, ``n0``, ``n1``: texts of label 0 and 1 in the sample that hold the cell (cell -1: all texts)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, BUCKETS), dtype=np.int32)
        texts = [0, 0]
        seen = np.zeros(BUCKETS, dtype=bool)
        for batch in batches:
            for text, y in zip(batch["text"], batch["label"]):
                seen[:] = False
                for g in grams(text):
                    seen[g] = True
                counts[int(y > 0)] += seen
                texts[int(y > 0)] += 1
        for y in (0, 1):
            cells = np.append(np.flatnonzero(counts[y]), -1)
            for start in range(0, len(cells), CELLS_PER_BATCH):
                cell = cells[start:start + CELLS_PER_BATCH].astype(np.int32)
                yield pd.DataFrame({"label": np.full(len(cell), y, dtype=np.int32), "cell": cell,
                                    "n": np.where(cell < 0, texts[y], counts[y][cell]).astype(np.int32)})

    of = lambda y: F.sum(F.when(F.col("label") == y, F.col("n")).otherwise(0))
    return sample.select("text", "label").mapInPandas(lean(run), "label int, cell int, n int") \
        .groupBy("cell").agg(of(0).alias("n0"), of(1).alias("n1"))


def fit(sample: DataFrame) -> Model:
    """Learn from ``text``, ``label`` rows (a bounded sample).

    With no rows, or rows of one label only, the scores are that label's
    smoothed share.
    """
    counts = stored(presence_counts(sample), "cells")
    totals = counts.filter("cell = -1").first()
    n0, n1 = (totals["n0"], totals["n1"]) if totals else (0, 0)
    prior = float(np.log((n1 + 0.5) / (n0 + 0.5)))
    slots = np.full(BUCKETS, -1, dtype=np.int32)
    if min(n0, n1) == 0:
        return Model(slots, np.zeros(1), prior)
    ratio = F.log((F.col("n1") + 0.5) / (n1 + 1.0)) - F.log((F.col("n0") + 0.5) / (n0 + 1.0))
    support = F.col("n0") + F.col("n1")
    best = counts.filter((F.col("cell") >= 0) & (support >= MIN_SUPPORT)) \
        .select("cell", ratio.alias("ratio"), (F.abs(ratio) * F.sqrt(support)).alias("telling")) \
        .filter("telling > 0").orderBy(F.desc("telling"), "cell").limit(FEATURES).collect()
    slots[[b["cell"] for b in best]] = np.arange(len(best))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = np.zeros((len(batch), FEATURES), dtype=np.uint8)
            for i, text in enumerate(batch["text"]):
                bits[i, present(text, slots)] = 1
            yield pd.DataFrame({"id": batch["__id"].astype(str), "label": batch["label"],
                                "bits": [r.tobytes() for r in np.packbits(bits, axis=1)]})

    rows = sample.mapInPandas(lean(run), "id string, label int, bits binary").toPandas().sort_values(["id", "bits"])
    y = (rows["label"].to_numpy() > 0).astype(np.float32)
    x = np.unpackbits(np.frombuffer(b"".join(rows["bits"]), dtype=np.uint8).reshape(len(rows), -1), axis=1)
    r = np.zeros(FEATURES, dtype=np.float32)
    r[:len(best)] = [b["ratio"] for b in best]
    w, bias = _logistic(x, y, r, prior)
    return Model(slots, (w * r).astype(np.float64), bias)


def _logistic(x: np.ndarray, y: np.ndarray, r: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on ``x * r`` by Adam, in blocks of rows (a block's floats: 16 MB)."""
    w, m, v = np.zeros(len(r), np.float32), np.zeros(len(r) + 1), np.zeros(len(r) + 1)
    blocks = [(x[i:i + 2048], y[i:i + 2048]) for i in range(0, len(y), 2048)]
    for t in range(1, STEPS + 1):
        grad = np.append(RIDGE * w, 0.0)
        for xb, yb in blocks:
            xf = xb.astype(np.float32)
            z = xf @ (w * r) + np.float32(bias)
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - yb) / len(y)
            grad[:-1] += (e @ xf) * r
            grad[-1] += e.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w -= step[:-1].astype(np.float32)
        bias -= float(step[-1])
    return w, bias


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``score`` (0 to 1) and ``predicted`` (score >= 0.5).

    A null or empty text has no features and scores the bias; whole texts are
    read; repeated rows are scored each; an empty table gives an empty result;
    columns not named are not read. The broadcast model is 4 MB, whatever the data.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    kept = Kept(docs, keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(**shared.value)
        for batch in batches:
            batch["__score"] = [own.score(t) for t in batch.pop("__text")]
            yield batch

    df = docs.select(*kept.sent, F.col(text_col).cast("string").alias("__text")) \
        .mapInPandas(lean(run), kept.schema("__score double")).withColumnRenamed("__score", "score")
    return kept.back(df).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic",
          max_rows: int = MAX_SAMPLE_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows for which ``usable`` holds."""
    small_batches(docs.sparkSession)
    return fit(labelled.sample(docs, labels, label, usable, max_rows))
