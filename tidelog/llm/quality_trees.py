"""Quality classifier: histogram gradient-boosted trees over document statistics.

``statistics`` turns a text into ``STATS`` numbers (lengths, character shares,
repetition, line shapes). Trees of depth ``DEPTH`` are grown on binned
statistics of a bounded labelled sample with the logistic loss; the forest is
flattened into arrays (feature, threshold, child, value) and a whole batch of
documents walks all trees at once, level by level, in numpy.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import labelled
from tidelog.llm.common import Kept, small_batches
from tidelog.llm.quality_rules import CLASSES, char_counts, repeated_words

# At most so many labelled rows are learnt from.
MAX_SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, MIN_ROWS = 80, 4, 64, 0.15, 1.0, 10

STATS = ("chars", "words", "lines", "chars_per_word", "words_per_line", "stops_per_word", "marks_per_word",
         "distinct_words", "top_word", "top3_words", "repeated_8_words", "same_as_before", "distinct_lines",
         "short_lines", "upper_words", "bars", "packed", *(f"share_{c}" for c in CLASSES))


def statistics(text: str | None) -> list[float]:
    """The numbers of ``STATS`` for one whole text; all 0 for a null or empty one."""
    if not text:
        return [0.0] * len(STATS)
    data = text.encode()
    words = data.split()
    n = max(1, len(words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    count = Counter(words)
    top = [c for _, c in count.most_common(3)] or [0]
    classes = char_counts(data)
    by_class = dict(zip(CLASSES, classes))
    total = max(1.0, classes.sum())
    packed = sum(len(zlib.compress(data[i:i + 65536], 1)) for i in range(0, len(data), 65536))
    return [
        float(len(text)), float(len(words)), float(len(lines)), sum(map(len, words)) / n,
        len(words) / max(1, len(lines)), by_class["stop"] / n, by_class["symbol"] / n,
        len(count) / n, top[0] / n, sum(top) / n, repeated_words(words) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, len(set(lines)) / max(1, len(lines)),
        sum(len(line) < 30 for line in lines) / max(1, len(lines)),
        sum(w.isupper() for w in words) / n, data.count(b"|") / n, packed / len(data),
        *(classes / total),
    ]


@dataclass
class Forest:
    """All trees in flat arrays; ``root`` has each tree's first node. A leaf is its own child."""

    bias: float
    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of statistics."""
        if len(self.root) == 0:
            z = np.full(len(x), self.bias)
        else:
            rows = np.arange(len(x))[:, None]
            node = np.broadcast_to(self.root, (len(x), len(self.root)))
            for _ in range(DEPTH):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            z = self.bias + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost ``TREES`` trees of depth ``DEPTH`` on rows ``x`` with labels ``y`` (0/1)."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    parts = {k: [] for k in ("root", "feature", "threshold", "left", "right", "value")}
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        z, size = np.full(len(y), bias), 0
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            tree, leaf = _tree(binned, edges, p - y, p * (1 - p))
            z += tree["value"][leaf]
            parts["root"].append(size)
            for k in ("left", "right"):
                tree[k] = tree[k] + size
            for k, v in tree.items():
                parts[k].append(v)
            size += len(tree["value"])
    kinds = {"feature": np.int64, "left": np.int64, "right": np.int64}
    flat = {k: np.concatenate(v) if v else np.zeros(0) for k, v in parts.items() if k != "root"}
    return Forest(bias, np.array(parts["root"], dtype=np.int64), **{k: v.astype(kinds.get(k, float))
                                                                   for k, v in flat.items()})


def _tree(binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[dict, np.ndarray]:
    """One tree by levels, from histograms of gradients; also each row's leaf."""
    n_nodes = 2 ** (DEPTH + 1) - 1
    tree = {"feature": np.zeros(n_nodes, np.int64), "threshold": np.full(n_nodes, np.inf),
            "left": np.arange(n_nodes), "right": np.arange(n_nodes), "value": np.zeros(n_nodes)}
    node = np.zeros(len(g), dtype=np.int64)
    for level in range(DEPTH):
        first, width = 2 ** level - 1, 2 ** level
        live = node >= first
        at = node[live] - first
        best = [(1e-6, -1, 0)] * width
        for f, e in enumerate(edges):
            if len(e) == 0:
                continue
            cell = at * BINS + binned[live, f]
            hist = [np.bincount(cell, weights=w, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1)
                    for w in (g[live], h[live], np.ones(len(at)))]
            (gl, hl, nl), (gt, ht, nt) = [a[:, :len(e)] for a in hist], [a[:, -1:] for a in hist]
            gain = gl ** 2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt ** 2 / (ht + RIDGE)
            gain[(nl < MIN_ROWS) | (nt - nl < MIN_ROWS)] = 0
            cut = gain.argmax(axis=1)
            for k in range(width):
                if gain[k, cut[k]] > best[k][0]:
                    best[k] = (gain[k, cut[k]], f, int(cut[k]))
        for k, (_, f, cut) in enumerate(best):
            if f < 0:
                continue
            i = first + k
            tree["feature"][i], tree["threshold"][i] = f, edges[f][cut]
            tree["left"][i], tree["right"][i] = 2 * i + 1, 2 * i + 2
            mine = node == i
            node[mine] = np.where(binned[mine, f] <= cut, 2 * i + 1, 2 * i + 2)
    gs, hs = np.bincount(node, weights=g, minlength=n_nodes), np.bincount(node, weights=h, minlength=n_nodes)
    tree["value"] = -RATE * gs / (hs + RIDGE)
    return tree, node


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality",
          max_rows: int = MAX_SAMPLE_ROWS) -> Forest:
    """Fit on at most ``max_rows`` labelled rows for which ``usable`` holds; only their
    statistics (200 bytes a row) reach the driver. No rows: every score is 0.5."""

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["__id"].astype(str), "label": batch["label"],
                                "stats": [statistics(t) for t in batch["text"]]})

    rows = labelled.sample(docs, labels, label, usable, max_rows) \
        .mapInPandas(run, "id string, label int, stats array<double>").toPandas()
    rows = rows.assign(key=[tuple(s) for s in rows["stats"]]).sort_values(["id", "key"])
    x = np.array(rows["stats"].tolist(), dtype=float).reshape(len(rows), len(STATS))
    return grow(x, (rows["label"].to_numpy(dtype=float) > 0).astype(float))


def score(docs: DataFrame, forest: Forest, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``score`` (0 to 1) and ``predicted`` (score >= 0.5).

    A null or empty text has statistics of 0 and is scored on them; whole texts
    are read; repeated rows are scored each; an empty table gives an empty
    result; columns not named are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(forest))
    kept = Kept(docs, keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Forest(**shared.value)
        for batch in batches:
            x = np.array([statistics(t) for t in batch.pop("__text")]).reshape(len(batch), len(STATS))
            batch["__score"] = own.score(x)
            yield batch

    df = docs.select(*kept.sent, F.col(text_col).cast("string").alias("__text")) \
        .mapInPandas(run, kept.schema("__score double")).withColumnRenamed("__score", "score")
    return kept.back(df).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
