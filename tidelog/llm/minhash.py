"""Near-duplicates by bottom-k MinHash sketches.

A document is the set of its distinct word shingles, hashed by one function; its
sketch is the ``k`` smallest hashes. Two documents link when
``100 * |x & y| >= percent * |x | y|``.

1. Documents with equal sets are one class, named by the set's 128-bit hash, so an
   id that occurs with several texts is in several classes and loses none.
2. Of a linked pair's union sketch at least ``least_shared`` values lie in both
   sketches: surely where the union has at most ``k`` shingles, else but for a
   chance of ``MISS`` per pair. So both hold a common value among the rarest
   ``|sketch| - least + 1`` of their own: only these are put in inverted lists. The
   order (rare first) is that of the counts of hashed cells over all sketches, which
   keeps the values of common passages out of the lists.
3. In every list the hub, the member whose values are most common, meets all others.
   Its near copies link to it without pairs among themselves.
4. What is then still in several components is gone through by hub (``blocks``): the
   lists of a hub are taken together, cut by set size and into blocks of bounded size.
5. A pair is a candidate when sizes, the union sketch's estimate and the hashed
   shingle counts (their summed difference never exceeds the symmetric difference)
   allow it. Candidates are confirmed on whole sets by exact Jaccard: those of hubs by
   joins; of blocks the members that have a candidate come again with their whole sets,
   and the block returns links only.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import blocks
from tidelog.llm.blocks import COUNTS, counts_of, most_difference
from tidelog.llm.common import Scratch, broadcast_if_small, small_batches, stored
from tidelog.llm.ngram_join import _WordHashes, components, shingles

K = 64                   # values of a sketch
MISS = 1e-9              # chance that a linked pair's union sketch shares too little
CELLS = 1 << 20          # counted cells of sketch values
CHUNK = 1 << 14          # cells of one row of counts
BLOCK = 1024             # members of one piece of a hub's group


def least_shared(percent: int, k: int = K, miss: float = MISS) -> int:
    """Values of a linked pair's full union sketch that lie in both sketches at least:
    ``k`` draws without replacement are no wider spread than ``k`` with."""
    p, below = percent / 100, 0.0
    for m in range(k + 1):
        below += comb(k, m) * p ** m * (1 - p) ** (k - m)
        if below > miss:
            return m
    return k


def least_of(n: np.ndarray | int, percent: int, k: int = K):
    """Sketch values a set of ``n`` shares with any set it links to, at least."""
    return np.minimum(least_shared(percent, k), -(-percent * n // 100))


def cell_of(values: np.ndarray) -> np.ndarray:
    return (values.view(np.uint64) >> np.uint64(11)).astype(np.int64) & (CELLS - 1)


def _records(rows: DataFrame, width: int) -> DataFrame:
    """Per row: id (as text: pandas would round it beside a null), text hash, set size, signature, sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _WordHashes()
        for batch in batches:
            out = []
            for i, h, text in zip(batch["id"], batch["text_hash"], batch["text"]):
                s = shingles(text, width, known)
                if len(s) == 0:
                    out.append((i, h, 0, None, None, None))
                else:
                    out.append((i, h, len(s), xxhash.xxh128_digest(s.tobytes()), s[:K].tobytes(), counts_of(s)))
            yield pd.DataFrame(out, columns=["id", "text_hash", "n", "signature", "sketch", "counts"])

    return rows.mapInPandas(run, "id string, text_hash bigint, n bigint, signature binary, sketch binary, counts binary")


def _cell_counts(sketches: DataFrame) -> np.ndarray:
    """How many sketches hold a value of each cell: ``CELLS`` numbers, whatever the data."""

    def rows(total: np.ndarray) -> Iterator[pd.DataFrame]:
        for chunk in np.flatnonzero(total.any(axis=1)):
            yield pd.DataFrame({"chunk": [chunk], "data": [total[chunk].tobytes()]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            total += np.bincount(cell_of(np.frombuffer(b"".join(batch["sketch"]), dtype=np.int64)), minlength=CELLS)
        yield from rows(total.reshape(-1, CHUNK))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((CELLS // CHUNK, CHUNK), dtype=np.int64)
        for batch in batches:
            for chunk, data in zip(batch["chunk"], batch["data"]):
                total[chunk] += np.frombuffer(data, dtype=np.int64)
        yield from rows(total)

    schema = "chunk int, data binary"
    summed = sketches.mapInPandas(count, schema).repartition(CELLS // CHUNK, "chunk").mapInPandas(add, schema).toPandas()
    out = np.zeros((CELLS // CHUNK, CHUNK), dtype=np.int64)
    for chunk, data in zip(summed["chunk"], summed["data"]):
        out[chunk] += np.frombuffer(data, dtype=np.int64)
    return np.minimum(out.reshape(-1), np.iinfo(np.int32).max).astype(np.int32)


def _postings(classes: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """``token``, ``signature``, ``n``, ``common``: the rarest values of every class's sketch."""
    shared = classes.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, commons = [], []
            for n, data in zip(batch["n"], batch["sketch"]):
                values = np.frombuffer(data, dtype=np.int64)
                held = shared.value[cell_of(values)]
                order = np.lexsort((values, held))
                tokens.append(values[order[:len(values) - int(least_of(n, percent)) + 1]])
                commons.append(float(np.log1p(held).mean()))
            times = [len(t) for t in tokens]
            yield pd.DataFrame({"token": np.concatenate(tokens), "signature": np.repeat(batch["signature"].to_numpy(), times),
                                "n": np.repeat(batch["n"].to_numpy(), times), "common": np.repeat(commons, times)})

    return classes.select("signature", "n", "sketch").mapInPandas(run, "token bigint, signature binary, n bigint, common double")


def _padded(sketches) -> np.ndarray:
    """One row of ``K`` sorted values per sketch; short ones end in the largest value."""
    out = np.full((len(sketches), K), np.iinfo(np.uint64).max, dtype=np.uint64)
    for row, data in enumerate(sketches):
        values = np.frombuffer(data, dtype=np.uint64)
        out[row, :len(values)] = values
    return out


def union_shared(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per pair of rows of ``_padded``: size of the union sketch (at most ``K``), and how many of its values both hold."""
    both = np.sort(np.concatenate([x, y], axis=1), axis=1)
    real = both != np.iinfo(np.uint64).max
    again = np.zeros(both.shape, dtype=bool)
    again[:, 1:] = both[:, 1:] == both[:, :-1]
    rank = np.cumsum(real & ~again, axis=1)
    inside = real & (rank <= K)
    return np.minimum(rank[:, -1], K), (inside & again).sum(axis=1)


def allowed(nx, ny, cx, cy, percent: int) -> np.ndarray:
    """Pairs that sizes and hashed counts do not rule out."""
    ok = np.minimum(nx, ny) * 100 >= np.maximum(nx, ny) * percent
    ok[ok] = np.abs(cx[ok] - cy[ok]).sum(axis=1) <= most_difference(percent, nx[ok], ny[ok])
    return ok


def estimated(nx, ny, kx, ky, percent: int) -> np.ndarray:
    """Pairs whose union sketch allows the link."""
    size, shared = union_shared(kx, ky)
    whole = (nx <= K) & (ny <= K) & (size < K)      # the union sketch is the union
    return np.where(whole, shared * 100 >= percent * size, shared >= least_shared(percent))


def _counts(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, COUNTS).astype(np.int16)


def _star_candidates(pairs: DataFrame, percent: int) -> DataFrame:
    """Candidates among pairs (a, b) that carry both sides' n, sketch and counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nx, ny = batch["na"].to_numpy(), batch["nb"].to_numpy()
            left = np.flatnonzero(allowed(nx, ny, _counts(batch["ca"]), _counts(batch["cb"]), percent))
            ok = estimated(nx[left], ny[left], _padded(batch["ka"].iloc[left]), _padded(batch["kb"].iloc[left]), percent)
            yield batch[["a", "b"]].iloc[left[ok]]

    return pairs.mapInPandas(run, "a binary, b binary")


def _sketch_test(percent: int):
    """Pairs of a block whose union sketches allow the link."""

    def test(rows: pd.DataFrame):
        n, sketches = rows["n"].to_numpy(), _padded(rows["sketch"])
        return lambda u, v: estimated(n[u], n[v], sketches[u], sketches[v], percent)

    return test


def _whole_sets(rows: DataFrame, wanted: DataFrame, width: int, work: Scratch) -> DataFrame:
    """``signature`` and ``set`` (sorted shingle hashes) of the ``wanted`` classes: signature, id, text_hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _WordHashes()
        for batch in batches:
            sets = [(g, shingles(t, width, known)) for g, t in zip(batch["signature"], batch["text"])]
            yield pd.DataFrame([(g, s.view(np.int64)) for g, s in sets if xxhash.xxh128_digest(s.tobytes()) == g],
                               columns=["signature", "set"])

    wanted = work.stored(wanted, "wanted")
    small = broadcast_if_small(wanted, F.lit(64)).alias("w")
    texts = rows.alias("r").join(small, F.col("r.text_hash").eqNullSafe(F.col("w.text_hash"))
                                 & F.col("r.id").eqNullSafe(F.col("w.id"))).select("w.signature", "r.text")
    sets = work.stored(texts.mapInPandas(run, "signature binary, set array<bigint>").dropDuplicates(["signature"]), "sets")
    work.drop(wanted)
    return sets


def _confirmed(rows: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int,
               work: Scratch) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    names = pairs.select(F.explode(F.array("a", "b")).alias("signature")).distinct()
    sets = _whole_sets(rows, classes.join(names, "signature", "left_semi"), width, work)
    both = pairs.join(sets.select(F.col("signature").alias("b"), F.col("set").alias("sb")), "b") \
        .join(sets.select(F.col("signature").alias("a"), F.col("set").alias("sa")), "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    links = work.stored(both.filter(shared * 100 >= (F.size("sa") + F.size("sb") - shared) * percent).select("a", "b"), "links")
    work.drop(sets)
    return links


def near_duplicates(docs: DataFrame, width: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` and ``kept``, one row per row of ``docs``.

    ``component_id`` is the smallest id reachable by links, itself included; a row
    is kept where that is its own id. A text without words, or null, has an empty
    set, links with nothing and is kept; one with fewer than ``width`` words is one
    shingle. A row without an id takes its group's component (null if none has an
    id) and is kept only if alone without words. Repeated rows each have a row with
    the same answer; an id with several texts belongs to the groups of all of
    them, and each of its rows has its own text's answer. An empty table gives an
    empty result; other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    work = Scratch(spark, "minhash")
    id_type = docs.schema[id_col].dataType
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    records = work.stored(_records(rows, width), "records")
    narrow = stored(records.select("id", "n", "signature"), "sets_of_rows")
    classes = work.stored(records.filter("n > 0").groupBy("signature").agg(
        F.min(F.struct("id", "text_hash")).alias("pick"), F.min(F.col("id").cast(id_type)).alias("smallest"),
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("counts").alias("counts")), "classes")
    work.drop(records)

    postings = _postings(classes, _cell_counts(classes.select("sketch")), percent)
    lists = postings.groupBy("token").agg(F.count(F.lit(1)).alias("members"),
                                          F.max(F.struct("common", "signature", "n")).alias("top")) \
        .filter("members > 1").select("token", "members", F.col("top.signature").alias("hub"), F.col("top.n").alias("n_hub"))
    joint = work.stored(postings.join(lists, "token").select("token", "signature", "n", "hub", "n_hub", "members"), "joint")

    def side(name: str) -> DataFrame:
        return classes.select(F.col("signature").alias(name), F.col("n").alias(f"n{name}"),
                              F.col("sketch").alias(f"k{name}"), F.col("counts").alias(f"c{name}"))

    sizes = F.least("n", "n_hub") * 100 >= F.greatest("n", "n_hub") * percent
    stars = joint.filter("signature <> hub").filter(sizes).select(F.least("signature", "hub").alias("a"),
                                                    F.greatest("signature", "hub").alias("b")).distinct() \
        .join(side("a"), "a").join(side("b"), "b")
    candidates = work.stored(_star_candidates(stars, percent), "star_candidates")
    own = classes.select("signature", "pick.id", "pick.text_hash")
    links = _confirmed(rows, own, candidates, width, percent, work)
    work.drop(candidates)
    of_pair = classes.select("signature", "n", "sketch", "counts")
    members = work.stored(blocks.open_members(joint, components(links), "signature", percent, BLOCK), "members")
    work.drop(joint)
    near = work.stored(blocks.near_members(members, of_pair, "signature", percent, _sketch_test(percent)), "near_members")
    work.drop(members)
    sets = _whole_sets(rows, own.join(near.select("signature").distinct(), "signature", "left_semi"), width, work)
    more = work.stored(blocks.links(near, sets.join(of_pair, "signature"), "signature", percent, _sketch_test(percent),
                                    lambda block_rows: lambda x, y: True), "block_links")
    work.drop(near, sets)
    label = components(links.unionByName(more))

    named = classes.select("signature", "smallest").join(label.withColumnRenamed("id", "signature"), "signature", "left") \
        .withColumn("component", F.coalesce("component", "signature"))
    least = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    answers = stored(named.join(least, "component").select("signature", "component_id"), "groups")
    work.close()
    own_id = F.col("id").cast(id_type)
    return narrow.join(answers, "signature", "left") \
        .select(own_id.alias(id_col), F.col("n").alias("n_shingles"),
                F.when(F.col("n") == 0, own_id).otherwise(F.col("component_id")).alias("component_id")) \
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
