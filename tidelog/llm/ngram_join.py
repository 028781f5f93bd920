"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles; two documents link when
``100 * |x & y| >= percent * |x | y|``. The result is each document's component.

1. Documents with equal sets (by a 128-bit hash) are one class.
2. Shingles have one global order, rare ones first: counts of hashed cells of
   all shingles (a fixed-size table), then the shingle's hash. Any order is
   right; this one keeps common passages out of the prefixes.
3. A document's ``l``-prefix is its first ``n - ceil(t n) + l`` shingles. Two
   documents that link share at least ``l`` shingles of their ``l``-prefixes.
   Each document picks its ``l`` (1 to ``MAX_MATCHES``) by estimated cost: postings
   to read, plus candidates to verify, which are estimated by the ``l``-th most
   common shingle of the prefix. A pair needs ``min(l_x, l_y)`` shared shingles.
4. In every posting list the hub (the member with the largest share of common
   shingles) is verified against all others first: its copies link to it without
   pairs among them. Lists whose members are by then in one component are done.
5. The other lists are taken together by hub (``blocks``) and looked at in blocks of
   bounded size. A pair from different components is a candidate when the sizes allow it,
   the sketches allow it (the summed difference of hashed shingle counts never exceeds
   the symmetric difference, so no link is lost) and the prefixes share enough shingles;
   the members of such pairs come again with their whole sets, and the block returns links only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import blocks
from tidelog.llm.blocks import COUNTS, counts_of, most_difference, n_shared
from tidelog.llm.common import Scratch, broadcast_if_small, lean, small_batches, stored

CELLS = 1 << 20          # counted cells of shingles
CHUNK = 1 << 14          # cells of one counts row
MAX_MATCHES = 4
WORDS_KEPT = 1 << 16     # word hashes that a task remembers
VERIFY_COST = 20.0       # a verification in postings
BLOCK = 1024             # members of one piece of a hub's group
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, width: int, known: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a whole text."""
    words = text.encode().translate(_FOLD).split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    n = len(h) - width + 1
    s = h[:n].copy()
    for k in range(1, width):
        s = (s ^ (s >> np.uint64(29))) * _MIX + h[k:k + n]
    s = (s ^ (s >> np.uint64(32))) * _MIX
    return np.unique(s ^ (s >> np.uint64(29)))


def _cells(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(20)).astype(np.int64) & (CELLS - 1)


def cell_counts(texts: DataFrame, width: int) -> np.ndarray:
    """How many documents' sets fall in each cell: ``CELLS`` numbers, whatever the data."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total = _WordHashes(), np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            held, size = [], 0
            for text in batch["text"]:
                held.append(_cells(shingles(text, width, known)))
                size += len(held[-1])
                if size > CELLS:
                    total += np.bincount(np.concatenate(held), minlength=CELLS)
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held), minlength=CELLS)
        yield from _chunks(enumerate(total.reshape(-1, CHUNK)))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch["chunk"], batch["data"]):
                row = np.frombuffer(data, dtype=np.int64)
                total[chunk] = total[chunk] + row if chunk in total else row
        yield from _chunks(total.items())

    schema = "chunk int, data binary"
    parts = texts.mapInPandas(lean(count), schema)
    # Partial sums are added as they stream by, so a task holds the chunks it owns and no more.
    summed = parts.repartition(CELLS // CHUNK, "chunk").mapInPandas(lean(add), schema).toPandas()
    out = np.zeros((CELLS // CHUNK, CHUNK), dtype=np.int64)
    for chunk, data in zip(summed["chunk"], summed["data"]):
        out[chunk] += np.frombuffer(data, dtype=np.int64)
    return np.minimum(out.reshape(-1), np.iinfo(np.int32).max).astype(np.int32)


def _chunks(items) -> Iterator[pd.DataFrame]:
    for chunk, row in items:
        yield pd.DataFrame({"chunk": [chunk], "data": [np.ascontiguousarray(row).tobytes()]})


def required(n: int, percent: int) -> int:
    """Shingles a set of ``n`` shares at least with any set it links to."""
    return -(-percent * n // 100)


def prefix(s: np.ndarray, counts: np.ndarray, background: float, percent: int) -> tuple[int, np.ndarray, float]:
    """``l``, the ``l``-prefix, and the share of common shingles (for the choice of hubs)."""
    n = len(s)
    freq = counts[_cells(s)]
    order = np.lexsort((s, freq))
    least = required(n, percent)
    longest = min(MAX_MATCHES, least)
    df = np.maximum(freq[order[:n - least + longest]] - background, 0.0)
    best = (np.inf, 1)
    for matches in range(1, longest + 1):
        own = df[:n - least + matches]
        candidates = np.partition(own, len(own) - matches)[len(own) - matches]
        best = min(best, (float(own.sum() + VERIFY_COST * candidates), matches))
    matches = best[1]
    return matches, s[order[:n - least + matches]], float((freq > 2 * background + 2).mean())


def _records(texts: DataFrame, width: int, percent: int, counts: np.ndarray) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(counts)
    background = float(np.median(counts))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _WordHashes()
        for batch in batches:
            rows = []
            for i, h, text in zip(batch["id"], batch["text_hash"], batch["text"]):
                s = shingles(text, width, known)
                if len(s) == 0:
                    rows.append((i, h, 0, None, 0, [], 0.0, None))
                    continue
                matches, first, common = prefix(s, shared.value, background, percent)
                rows.append((i, h, len(s), xxhash.xxh128_digest(s.tobytes()), matches, first.view(np.int64), common, counts_of(s)))
            yield pd.DataFrame(rows, columns=["id", "text_hash", "n", "signature", "matches", "prefix", "common", "sketch"])

    return texts.mapInPandas(lean(run), "id string, text_hash bigint, n bigint, signature binary, matches int, "
                                  "prefix array<bigint>, common double, sketch binary")


def whole_sets(rows: DataFrame, wanted: DataFrame, width: int, work: Scratch) -> DataFrame:
    """``cls`` and ``set`` (sorted shingle hashes) of the ``wanted`` classes: cls, signature, id, text_hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _WordHashes()
        for batch in batches:
            sets = [(c, g, shingles(t, width, known)) for c, g, t in zip(batch["cls"], batch["signature"], batch["text"])]
            yield pd.DataFrame([(c, s.view(np.int64)) for c, g, s in sets if xxhash.xxh128_digest(s.tobytes()) == g],
                               columns=["cls", "set"])

    wanted = work.stored(wanted, "wanted")
    small = broadcast_if_small(wanted, F.lit(72)).alias("w")
    texts = rows.alias("r").join(small, F.col("r.text_hash").eqNullSafe(F.col("w.text_hash"))
                                 & F.col("r.id").eqNullSafe(F.col("w.id"))).select("w.cls", "w.signature", "r.text")
    sets = work.stored(texts.mapInPandas(lean(run), "cls bigint, set array<bigint>").dropDuplicates(["cls"]), "sets")
    work.drop(wanted)
    return sets


def verified(rows: DataFrame, wanted: DataFrame, pairs: DataFrame, width: int, percent: int, work: Scratch) -> DataFrame:
    """The pairs (a, b) of classes that link, checked on their whole sets."""
    names = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = whole_sets(rows, wanted.join(names, "cls", "left_semi"), width, work)
    both = pairs.join(sets.select(F.col("cls").alias("b"), F.col("set").alias("sb")), "b") \
        .join(sets.select(F.col("cls").alias("a"), F.col("set").alias("sa")), "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - shared
    links = work.stored(both.filter(shared * 100 >= union * percent).select("a", "b"), "links")
    work.drop(sets)
    return links


def sizes_allow(percent: int, x: Column, y: Column) -> Column:
    return (F.least(x, y) * 100 >= F.greatest(x, y) * percent)


def components(links: DataFrame) -> DataFrame:
    """``id``, ``component`` (smallest id reachable) of all ends of ``links`` (a, b).

    Labels shrink to the smallest among neighbours and then to the label's own
    label, so chains halve in each round; every round is a table of its own.
    """
    work = Scratch(links.sparkSession, "components")
    edges = work.stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                        .distinct(), "edges")
    label = edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component"))
    held = work.stored(label, "labels")
    while True:
        label = held.select("id", "component")
        near = edges.join(label.withColumnsRenamed({"id": "b"}), "b") \
            .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = label.join(near, "id").select("id", F.least("component", "near").alias("to"), "component")
        jump = label.select(F.col("id").alias("to"), F.col("component").alias("beyond"))
        after = work.stored(step.join(jump, "to", "left").select(
            "id", F.least("to", F.coalesce("beyond", "to")).alias("component"),
            (F.least("to", F.coalesce("beyond", "to")) != F.col("component")).alias("moved")), "labels")
        work.drop(held)
        held = after
        if not after.filter("moved").limit(1).count():
            out = stored(after.select("id", "component"), "components")
            work.close()
            return out


def _sketch_filter(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sketches do not rule the link out."""
    kept = [f for f in pairs.schema.fields if f.name in ("a", "b")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch[c]), dtype=np.uint8).reshape(-1, COUNTS).astype(np.int16)
                    for c in ("ka", "kb"))
            na, nb = batch["na"].to_numpy(), batch["nb"].to_numpy()
            ok = np.abs(x - y).sum(axis=1) <= most_difference(percent, na, nb)
            yield batch.loc[ok, ["a", "b"]]

    return pairs.mapInPandas(lean(run), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept))


def _any_pair(rows: pd.DataFrame):
    return lambda u, v: np.ones(len(u), dtype=bool)


def _prefix_test(rows: pd.DataFrame):
    """Of a block's pairs, those whose prefixes share enough shingles are compared whole."""
    matches = rows["matches"].to_numpy()
    first = [np.sort(np.asarray(p, dtype=np.int64)) for p in rows["prefix"]]
    return lambda x, y: n_shared(first[x], first[y]) >= min(matches[x], matches[y])


def similar(docs: DataFrame, width: int, percent: int, id_col: str = "doc_id", text_col: str = "text",
            with_text_hash: bool = False) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id``, one row per row of ``docs``.

    ``component_id`` is the smallest id reachable by links, itself included. A
    text without words has an empty set and links with nothing; one with fewer
    than ``width`` words is one shingle. A row with a null id joins the component
    of its set, and is null where no row of that has an id. Repeated rows each
    have a row; an id with several texts belongs to the components of all of them,
    and each of its rows has its own text's (``with_text_hash`` adds ``text_hash``,
    the xxhash64 of the text, to tell them apart). An empty table gives an empty
    result; other columns are not read. Ids are whole numbers.
    """
    spark = docs.sparkSession
    small_batches(spark)
    work = Scratch(spark, "ngram_join")
    id_type = docs.schema[id_col].dataType
    text = F.col(text_col).cast("string")
    # ids go to Python as text: pandas would round them beside a null
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    counts = cell_counts(rows.select("text"), width)
    records = work.stored(_records(rows, width, percent, counts), "records")
    narrow = stored(records.select("id", "text_hash", "n", "signature"), "sets_of_rows")
    # One class per set. Its number is drawn as the table is written, and short: it is in every posting.
    own = work.stored(records.filter("n > 0").groupBy("signature").agg(
        F.min(F.struct("id", "text_hash")).alias("pick"), F.min(F.col("id").cast(id_type)).alias("smallest"),
        *[F.first(c).alias(c) for c in ("n", "matches", "prefix", "common", "sketch")])
        .withColumn("cls", F.monotonically_increasing_id()), "classes")
    work.drop(records)

    postings = own.select("cls", "n", "common", F.explode("prefix").alias("token"))
    lists = postings.groupBy("token").agg(
        F.count(F.lit(1)).alias("members"), F.max(F.struct("common", "cls", "n")).alias("top")) \
        .filter("members > 1").select("token", "members", F.col("top.cls").alias("hub"), F.col("top.n").alias("n_hub"))
    joint = work.stored(postings.join(lists, "token").select("token", "cls", "n", "hub", "n_hub", "members"), "postings")

    size = own.select("cls", "n", "sketch")
    a_side, b_side = (size.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"k{c}")) for c in "ab")
    stars = joint.filter("cls <> hub").filter(sizes_allow(percent, F.col("n"), F.col("n_hub"))) \
        .select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct() \
        .join(a_side, "a").join(b_side, "b")
    tried = work.stored(_sketch_filter(stars, percent), "star_pairs")
    wanted = own.select("cls", "signature", "pick.id", "pick.text_hash")
    links = verified(rows, wanted, tried, width, percent, work)
    work.drop(tried)
    members = work.stored(blocks.open_members(joint, components(links), "cls", percent, BLOCK), "members")
    work.drop(joint)
    of_pair = own.select("cls", "n", F.col("sketch").alias("counts"))
    near = work.stored(blocks.near_members(members, of_pair, "cls", percent, _any_pair), "near_members")
    work.drop(members)
    sets = whole_sets(rows, wanted.join(near.select("cls").distinct(), "cls", "left_semi"), width, work)
    whole = sets.join(own.select("cls", "n", F.col("sketch").alias("counts"), "matches", "prefix"), "cls")
    more = work.stored(blocks.links(near, whole, "cls", percent, _any_pair, _prefix_test), "block_links")
    work.drop(near, sets)
    final = components(links.unionByName(more))

    classes = own.select("cls", "signature", "smallest").join(final.withColumnRenamed("id", "cls"), "cls", "left") \
        .withColumn("component", F.coalesce("component", "cls"))
    least = classes.groupBy("component").agg(F.min("smallest").alias("component_id"))
    answers = stored(classes.join(least, "component").select("signature", "component_id"), "groups")
    work.close()
    own_id = F.col("id").cast(id_type)
    return narrow.join(answers, "signature", "left").select(
        own_id.alias(id_col), *(["text_hash"] if with_text_hash else []), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, own_id).otherwise(F.col("component_id")).alias("component_id"))
