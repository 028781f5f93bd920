"""Ranked lexical search by dual trees, exact.

Every document is a vector over the items' terms (a term's saturated frequency), every
item one of term weights; a score is their product in whole numbers.

1. Items go in batches with a bounded number of terms. Per batch one pass over the
   whole texts stores each document's length and its counts of the batch's terms.
2. Items form a hierarchy: neighbours by their weightiest term, ``ITEM_LEAF`` to a
   leaf, ``FANOUT`` to a node; a node holds each weight's maximum.
3. Every task sorts its documents, ``CHUNK`` at a time, by their weightiest term into
   leaves of ``DOC_LEAF`` and nodes above them, which hold each coordinate's maximum
   and the smallest id.
4. Node pairs are looked at from the roots down. The product of the maxima bounds
   every score below; a pair goes when the bound is under the weakest k-th score of
   its items, or equal to it with no smaller id left. Leaf pairs are scored in full.
5. A task gives its best ``k`` per item; the best of all tasks are ranked. A first
   search over a hashed part of the documents (``SEED_ROWS`` of them expected) gives
   each item a k-th score to start from; it saves work and changes no answer.

All scores and bounds are sums of products of whole numbers below 2**53, so they are
exact as doubles.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch, small_batches, stored

BATCH_ITEMS = 256        # items of one batch
BATCH_TERMS = 10_000     # distinct terms of one batch, but for a single item with more
ITEM_LEAF, DOC_LEAF, FANOUT = 8, 64, 4
CHUNK = 1024             # documents of one hierarchy
NO_ID = np.iinfo(np.int64).max
SEED_ROWS = 20_000
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def terms(text: str | None) -> list[str]:
    return TERM.findall(text.translate(FOLD)) if text else []


def item_batches(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, Any, list[str]]]]:
    """Lists of (number, id, distinct terms) of at most ``BATCH_ITEMS`` items, read as a stream."""
    batch, held = [], set()
    for number, row in enumerate(items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
                                 .toLocalIterator()):
        own = sorted(set(terms(row.text)))
        if batch and (len(batch) == BATCH_ITEMS or len(held.union(own)) > BATCH_TERMS):
            yield batch
            batch, held = [], set()
        if own:
            batch.append((number, row.id, own))
            held.update(own)
    if batch:
        yield batch


def _counted(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """``doc``, ``n`` (all terms) and the numbers and counts of the vocabulary's terms, per document."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = known.value
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc"], batch["text"]):
                found = terms(text)
                held = {number[t]: c for t, c in Counter(found).items() if t in number}
                out.append((doc, len(found), sorted(held), [held[t] for t in sorted(held)]))
            yield pd.DataFrame(out, columns=["doc", "n", "terms", "counts"])

    return docs.mapInPandas(run, "doc string, n bigint, terms array<int>, counts array<bigint>")


class ItemTree:
    """Levels of the items' hierarchy, leaves first: (nodes x terms) maxima of the weights."""

    def __init__(self, weights: np.ndarray, k: int) -> None:
        lead = np.argmax(weights, axis=1) if weights.size else np.zeros(0, int)
        self.order = np.lexsort((np.arange(len(lead)), lead))
        self.items = weights[self.order]
        self.levels = [_maxima(self.items, ITEM_LEAF)]
        while len(self.levels[-1]) > 1:
            self.levels.append(_maxima(self.levels[-1], FANOUT))
        self.k = k


def _maxima(rows: np.ndarray, size: int) -> np.ndarray:
    return np.maximum.reduceat(rows, np.arange(0, len(rows), size), axis=0)


def _minima(rows: np.ndarray, size: int) -> np.ndarray:
    return np.minimum.reduceat(rows, np.arange(0, len(rows), size))


class Best:
    """The ``k`` best (score, id) of every item so far. ``score`` and ``doc`` are the weakest of ``k``;
    before there are so many, only scores above ``floor`` are wanted."""

    def __init__(self, n_items: int, k: int, floor: np.ndarray) -> None:
        self.k, self.heaps, self.offers = k, [[] for _ in range(n_items)], 0
        self.score, self.doc = floor.copy(), np.full(n_items, NO_ID)

    def offer(self, item: int, score: float, doc: int, name: Any) -> None:
        heap, self.offers = self.heaps[item], self.offers + 1
        if len(heap) < self.k:
            heapq.heappush(heap, (score, -doc, self.offers, name))
        elif (score, -doc) > heap[0][:2]:
            heapq.heapreplace(heap, (score, -doc, self.offers, name))
        if len(heap) == self.k and heap[0][0] >= self.score[item]:
            self.score[item], self.doc[item] = heap[0][0], -heap[0][1]


def search_chunk(tree: ItemTree, best: Best, docs: np.ndarray, term: np.ndarray, value: np.ndarray,
                 ids: np.ndarray, names: list) -> int:
    """Offer to ``best`` all documents of a chunk that can be among an item's best: ``term`` and ``value`` are
    the coordinates of the document numbers ``docs``. Returns how many leaf pairs were scored."""
    used, column = np.unique(term, return_inverse=True)
    dense = np.zeros((len(names), len(used)))
    dense[docs, column] = value
    weighty = np.lexsort((-value * tree.levels[-1][0][term], docs))
    lead = column[weighty[np.searchsorted(docs[weighty], np.arange(len(names)))]]
    order = np.lexsort((ids, lead))
    dense, ids, names = dense[order], ids[order], [names[k] for k in order]
    doc_levels, least = [_maxima(dense, DOC_LEAF)], [_minima(ids, DOC_LEAF)]
    while len(doc_levels[-1]) > 1:
        doc_levels.append(_maxima(doc_levels[-1], FANOUT))
        least.append(_minima(least[-1], FANOUT))
    item_levels = [level[:, used] for level in tree.levels]
    weights = tree.items[:, used]
    scored = 0

    def open_(items: int, doc_level: int, node: int, rows: np.ndarray) -> np.ndarray:
        """Of the item nodes ``rows`` of a level, those that the document node may serve."""
        bound = item_levels[items][rows] @ doc_levels[doc_level][node]
        size = ITEM_LEAF * FANOUT ** items
        keep = []
        for row, b in zip(rows, bound):
            weakest = best.score[row * size:(row + 1) * size]
            low = weakest.min()
            if b > 0 and (b > low or (b == low and (best.doc[row * size:(row + 1) * size][weakest == low] > least[doc_level][node]).any())):
                keep.append(row)
        return np.array(keep, dtype=int)

    todo = [(len(doc_levels) - 1, 0, len(item_levels) - 1, np.array([0]))]
    while todo:
        level, node, items, rows = todo.pop()
        rows = open_(items, level, node, rows)
        if not len(rows):
            continue
        if items:
            below = (rows[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            todo.append((level, node, items - 1, below[below < len(item_levels[items - 1])]))
        elif level:
            todo += [(level - 1, child, 0, rows)
                     for child in range(min((node + 1) * FANOUT, len(doc_levels[level - 1])) - 1, node * FANOUT - 1, -1)]
        else:
            at = np.arange(node * DOC_LEAF, min((node + 1) * DOC_LEAF, len(dense)))
            who = (rows[:, None] * ITEM_LEAF + np.arange(ITEM_LEAF)).ravel()
            who = who[who < len(weights)]
            scores = weights[who] @ dense[at].T
            scored += len(rows)
            good = (scores > 0) & ((scores > best.score[who][:, None])
                                   | ((scores == best.score[who][:, None]) & (ids[at] < best.doc[who][:, None])))
            for x, y in zip(*np.nonzero(good)):
                best.offer(who[x], scores[x, y], ids[at[y]], names[at[y]])
    return scored


def _search(vectors: DataFrame, tree: ItemTree, floor: np.ndarray, mean: tuple[int, int]) -> DataFrame:
    """``item`` (number in the tree), ``score`` and ``doc`` of every task's best."""
    shared = vectors.sparkSession.sparkContext.broadcast((tree, floor))
    n_docs, n_terms = mean

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, floor = shared.value
        best = Best(len(tree.items), tree.k, floor)

        def search(chunk: pd.DataFrame) -> None:
            size = chunk["terms"].map(len).to_numpy()
            tf, term = np.concatenate(chunk["counts"].to_list()), np.concatenate(chunk["terms"].to_list())
            m = np.repeat(100 - 90 + 90 * chunk["n"].to_numpy() * n_docs // n_terms, size)
            value = 1_000_000_000 * tf // (1000 * tf + 8 * m)
            names = chunk["doc"].to_list()
            search_chunk(tree, best, np.repeat(np.arange(len(names)), size), term, value, chunk["place"].to_numpy(), names)

        held, n = [], 0
        for batch in batches:
            held.append(batch[batch["terms"].map(len) > 0])
            n += len(held[-1])
            if n >= CHUNK:
                search(pd.concat(held, ignore_index=True))
                held, n = [], 0
        if n:
            search(pd.concat(held, ignore_index=True))
        rows = [(item, int(score), doc) for item, heap in enumerate(best.heaps) for score, _, _, doc in heap]
        yield pd.DataFrame(rows, columns=["item", "score", "doc"])

    return vectors.mapInPandas(run, "item int, score bigint, doc string")


def _ranked(found: DataFrame, id_type, k: int) -> DataFrame:
    """The ``k`` best rows of every item: tasks times ``k`` rows an item come in."""
    id_ = F.col("doc").cast(id_type)
    by = Window.partitionBy("item").orderBy(F.desc("score"), id_.asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """``item_col``, ``rank``, ``id_col`` and ``score`` of each item's ``k`` best documents with a score above 0.

    Equal scores go by ascending id, null ids last. Null and empty texts have no
    terms: such items get no row, such documents are found by none and not counted.
    Every row of ``docs`` is a document of its own, every row of ``items`` an item of
    its own (so equal items get their rows each). Empty tables give an empty result;
    other columns are not read. Whole texts are read, once per batch of items. Ids of
    documents are whole numbers.
    """
    spark = docs.sparkSession
    small_batches(spark)
    work = Scratch(spark, "lexical_search")
    id_type = docs.schema[id_col].dataType
    texts = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).cast("string").alias("text"))
    out = None
    for batch in item_batches(items, item_col, text_col):
        vocabulary = {t: c for c, t in enumerate(sorted({t for _, _, own in batch for t in own}))}
        vectors = work.stored(_counted(texts, vocabulary), "vectors")
        n_docs, n_terms, with_terms = vectors.agg(
            F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.size("terms") > 0, 1))).first()
        if not with_terms:
            continue
        df = dict(map(tuple, vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect()))
        weights = np.zeros((len(batch), len(vocabulary)))
        for row, (_, _, own) in enumerate(batch):
            for t in own:
                number = vocabulary[t]
                weights[row, number] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(number, 0) + 1)))
        tree = ItemTree(weights, k)
        ready = vectors.withColumn("place", F.coalesce(F.col("doc").cast("bigint"), F.lit(int(NO_ID))))
        parts = max(1, with_terms // SEED_ROWS)
        floor = np.zeros(len(batch))
        if parts > 1:
            seed = _ranked(_search(ready.filter(F.pmod(F.xxhash64("doc"), F.lit(parts)) == 0), tree, floor, (n_docs, n_terms)), id_type, k)
            for r in seed.filter(F.col("rank") == k).collect():
                floor[r["item"]] = r["score"] - 0.5   # its equals are still wanted
        found = _search(ready, tree, floor, (n_docs, n_terms))
        names = spark.createDataFrame([(place_, batch[row][1]) for place_, row in enumerate(tree.order.tolist())],
                                      f"item int, {item_col} {items.schema[item_col].dataType.simpleString()}")
        ranked = stored(_ranked(found, id_type, k).join(names, "item").select(
            item_col, F.col("rank").cast("int").alias("rank"), F.col("doc").cast(id_type).alias(id_col), "score"), "found")
        out = ranked if out is None else out.unionByName(ranked)
        work.drop(vectors)
    if out is None:
        out = items.select(item_col, F.lit(0).alias("rank"), F.lit(None).cast(id_type).alias(id_col),
                           F.lit(0).cast("bigint").alias("score")).limit(0)
    return out
