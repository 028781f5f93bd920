"""Links inside groups of inverted lists, decided on whole sets in the task that meets them.

The hub of a list has met all other members before. What is left are pairs of other
members that are in different components. The lists of one group of near copies have one
hub, so they are taken together: a member stands once in its hub's group, whatever the
number of lists, with its whole set. A group is cut by set size and then into blocks of
bounded size. A block looks at every pair of its members once, and returns links only, at
most one less than it has members: pairs that are near but do not link are never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import lean

COUNTS = 128                # hashed shingle counts of a set
PIECE_SHINGLES = 1 << 20    # in the sets of one piece of a group, about; a block holds one or two pieces
_KEY = ["hub", "span", "i", "j"]


def counts_of(s: np.ndarray) -> bytes:
    """Shingles by hashed cell, at most 255 each."""
    return np.minimum(np.bincount((s >> np.uint64(7)).astype(np.int64) & (COUNTS - 1), minlength=COUNTS),
                      255).astype(np.uint8).tobytes()


def counts_array(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, COUNTS).astype(np.int16)


def most_difference(percent: int, nx, ny):
    """The largest symmetric difference of linked sets of these sizes."""
    return nx + ny - 2 * (-(-(percent * (nx + ny)) // (100 + percent)))


def n_shared(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two sorted arrays without repeats."""
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def open_members(joint: DataFrame, label: DataFrame, key: str, percent: int, piece: int) -> DataFrame:
    """Members of hubs' groups that are in several components, each with its piece (of about
    ``piece`` members at most) of its group.

    ``joint`` has a row per list and member: ``token``, ``key``, ``n``, ``hub``, ``members``.
    Linked sets are of one or of neighbouring spans of sizes, so a member stands in its own
    span and, as ``low``, in the next; two low ones meet elsewhere. ``lists`` has a bit for
    each list by its hash: members without a common bit are in no common list.
    """
    width = F.lit(log(100 / percent) * 1.0001 + 1e-9)
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(token), 64) AS int))")
    spans = joint.filter((F.col("members") > 2) & (F.col(key) != F.col("hub"))) \
        .groupBy("hub", key, "n").agg(F.bit_or(bit).alias("lists")) \
        .join(label.withColumnRenamed("id", key), key, "left") \
        .withColumn("component", F.coalesce("component", key)) \
        .withColumn("own", F.floor(F.log("n") / width)) \
        .withColumn("span", F.explode(F.array(F.col("own"), F.col("own") + 1))).withColumn("low", F.col("own") < F.col("span"))
    open_spans = spans.groupBy("hub", "span").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("low").alias("all_low"),
        F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(piece), F.sum("n") / F.lit(PIECE_SHINGLES))).cast("int").alias("cuts")) \
        .filter("lo < hi AND NOT all_low").select("hub", "span", "cuts")
    return spans.join(open_spans, ["hub", "span"]) \
        .select("hub", "span", "cuts", F.pmod(F.xxhash64(key), F.col("cuts")).cast("int").alias("piece"),
                "low", "lists", "component", key)


def near_members(members: DataFrame, classes: DataFrame, key: str, percent: int, vector: Callable) -> DataFrame:
    """``members`` without those that sizes, hashed counts and ``vector`` let link to no other component.

    ``classes`` has ``key``, ``n``, ``counts`` and what ``vector`` reads. A row per member at
    most leaves a block, never a pair, and no whole set is sent yet.
    """
    def near(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
        u, v, _ = _candidates(rows, first, rows["n"].to_numpy(), counts_array(rows["counts"]), percent, vector(rows))
        return rows.iloc[np.unique(np.concatenate([u, v]))][["hub", "span", "name"]]

    types = {f.name: f.dataType.simpleString() for f in members.schema.fields}
    found = _blocks(members, classes, key).mapInPandas(
        lean(_whole_blocks(near)), f"hub {types['hub']}, span {types['span']}, name {types[key]}").distinct()
    return members.join(found.withColumnRenamed("name", key), ["hub", "span", key], "left_semi")


def links(members: DataFrame, sets: DataFrame, key: str, percent: int, vector: Callable, pair: Callable) -> DataFrame:
    """Links (a, b) that join the components which some pair of a group's members links.

    ``members`` is of ``open_members``; ``sets`` has ``key``, ``n``, ``counts``, ``set`` (sorted
    hashes of the whole set) and what the two tests read. They get rows and return a function
    of row numbers: ``vector`` for arrays of pairs, which may link; ``pair`` for one, whether
    it is worth comparing whole. Pairs are taken by the difference of their hashed counts,
    nearest first.
    """
    def decide(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
        n, block, comp = rows["n"].to_numpy(), np.cumsum(first), pd.factorize(rows["component"])[0]
        u, v, gap = _candidates(rows, first, n, counts_array(rows["counts"]), percent, vector(rows))
        sets_ = [np.asarray(s, dtype=np.int64).view(np.uint64) for s in rows["set"]]
        worth, name = pair(rows), rows["name"].to_numpy()
        # a block's rows of one component start out as one, named by its first row
        start = pd.Series(np.arange(len(rows))).groupby([block, comp]).transform("min").to_numpy()
        ends, parent = [], list(range(len(rows)))

        def root(z: int) -> int:
            while parent[z] != z:
                parent[z] = z = parent[parent[z]]
            return z

        order = np.argsort(gap, kind="stable")
        for x, y in zip(u[order].tolist(), v[order].tolist()):
            p, q = root(start[x]), root(start[y])
            if p == q or not worth(x, y):
                continue
            shared = n_shared(sets_[x], sets_[y])
            if shared * 100 >= (n[x] + n[y] - shared) * percent:
                parent[max(p, q)] = min(p, q)
                ends.append(sorted((name[x], name[y])))
        return pd.DataFrame({"a": [e[0] for e in ends], "b": [e[1] for e in ends]}, dtype=None if ends else object)

    type_ = sets.schema[key].dataType.simpleString()
    return _blocks(members, sets, key).mapInPandas(lean(_whole_blocks(decide)), f"a {type_}, b {type_}").distinct()


def _blocks(members: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """Every unordered pair of pieces of a span is one block; a member goes to each block of its piece."""
    others = [c for c in classes.columns if c != key]
    return members.join(classes, key).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))) \
        .withColumn("i", F.least("piece", "other")).withColumn("j", F.greatest("piece", "other")) \
        .withColumn("side", F.when(F.col("i") == F.col("j"), 0).when(F.col("piece") == F.col("i"), -1).otherwise(1)) \
        .select(*_KEY, "side", "low", "lists", "component", F.col(key).alias("name"), *others) \
        .repartition(*_KEY).sortWithinPartitions(*_KEY)


def _candidates(rows: pd.DataFrame, first: np.ndarray, n: np.ndarray, counts: np.ndarray, percent: int,
                test: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one block that may link, and the share of their hashed counts that differs."""
    end = np.append(np.flatnonzero(first)[1:], len(rows))[np.cumsum(first) - 1]
    side, low, lists = (rows[c].to_numpy() for c in ("side", "low", "lists"))
    comp = pd.factorize(rows["component"])[0]
    none = np.zeros(0, dtype=np.int64)
    found = [(none, none, none.astype(float))]
    x, lag = np.arange(len(rows)), 0
    while True:
        lag += 1
        x = x[x + lag < end[x]]
        if len(x) == 0:
            break
        y = x + lag
        ok = (comp[x] != comp[y]) & ((side[x] == 0) | (side[x] != side[y])) & ~(low[x] & low[y]) \
            & ((lists[x] & lists[y]) != 0) & (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent)
        u, v = x[ok], y[ok]
        gap = np.abs(counts[u] - counts[v]).sum(axis=1)
        ok = gap <= most_difference(percent, n[u], n[v])
        u, v, gap = u[ok], v[ok], gap[ok] / (n[u[ok]] + n[v[ok]])
        ok = test(u, v)
        if ok.any():
            found.append((u[ok], v[ok], gap[ok]))
    u, v, gap = (np.concatenate(part) for part in zip(*found))
    return u, v, gap


def _whole_blocks(of_blocks: Callable) -> Callable:
    """A mapInPandas function that hands whole blocks on; rows arrive sorted by block, as a stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            first = _firsts(batch)
            last = int(np.flatnonzero(first)[-1])
            if last:
                yield of_blocks(batch.iloc[:last], first[:last])
            held = batch.iloc[last:]
        if held is not None and len(held):
            yield of_blocks(held, _firsts(held))

    return run


def _firsts(rows: pd.DataFrame) -> np.ndarray:
    """Where a block begins."""
    new = np.zeros(len(rows), dtype=bool)
    new[0] = True
    for c in _KEY:
        values = rows[c].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return new
