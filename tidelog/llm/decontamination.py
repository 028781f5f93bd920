"""Benchmark decontamination with DataFrame functions only.

Words are runs of digits, lower-cased ASCII letters and characters beyond
ASCII. A window is ``WIDTH`` consecutive words of an item; an item with fewer
words is one window of its own length. A document word is hit when it lies in
an occurrence of a window.

1. The items' windows make a hash set, broadcast only after its size is
   checked (otherwise the joins shuffle).
2. Documents are scanned for aligned blocks: any occurrence of a window of
   ``w`` words covers a block of ``(w + 1) // 2`` words that starts at a multiple
   of that length, so hashing every such block once (not every window) finds
   each document that may hold a window. Block lengths are those of the item
   windows: one, plus one for each shorter item length.
3. Only these documents are scanned window by window; hits are verified word by
   word, and their word positions and items are gathered by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import broadcast_if_small, stored

WIDTH = 10

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else (``lower`` is the fast way where all is ASCII)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)) \
        .otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """The words of a text; null and empty texts have none."""
    parts = F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), _GAP)
    return F.filter(parts, lambda w: w != F.lit(""))


def _hash(array: Column, start: Column, length: int) -> Column:
    """Hash of ``length`` words from position ``start`` (0-based)."""
    return F.xxhash64(*[F.get(array, start + F.lit(i)) for i in range(length)])


def item_windows(bench: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id`` (text), ``window`` (words), ``width``: every window of every item, distinct."""
    items = bench.select(F.col(item_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w")) \
        .filter(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(WIDTH))
    starts = F.sequence(F.lit(1), F.size("w") - width + F.lit(1))
    return items.withColumn("start", F.explode(starts)) \
        .select("item_id", F.slice("w", F.col("start"), width).alias("window"), width.alias("width")).distinct()


def _hashes(array: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` words (there are that many words at least)."""
    return F.transform(F.sequence(F.lit(0), F.size(array) - F.lit(length)), lambda i: _hash(array, i, length))


def _windows(array: Column, length: int) -> Column:
    """Hash and words of all runs of ``length`` words (there are that many words at least)."""
    return F.transform(
        F.sequence(F.lit(0), F.size(array) - F.lit(length)),
        lambda i: F.struct(_hash(array, i, length).alias("h"), F.slice(array, i + F.lit(1), length).alias("s")))


def _blocks(array: Column, block: int) -> Column:
    """Hashes of the aligned blocks of ``block`` words."""
    n = F.floor(F.size(array) / F.lit(block)).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - F.lit(1)),
                                     lambda j: _hash(array, j * F.lit(block), block))) \
        .otherwise(F.array().cast("array<bigint>"))


def hits(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id") -> DataFrame:
    """One row per document with a hit: ``__row`` key columns, ``hit`` (sorted word
    positions from 0) and ``items`` (sorted item ids as text).

    The key is (id, hash of the text), so repeated and null ids are told apart;
    rows equal in both have equal results.
    """
    windows = stored(item_windows(bench, item_col), "item_windows")
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())  # at most WIDTH values
    key = [F.col(id_col).cast("string").alias("__id"),
           F.xxhash64(F.col(text_col).cast("string")).alias("__text_hash")]
    texts = docs.select(*key, F.col(text_col).cast("string").alias("__text"))
    keys = ["__id", "__text_hash"]
    empty = texts.select(*keys, F.lit(None).cast("array<int>").alias("hit"),
                         F.lit(None).cast("array<string>").alias("items")).limit(0)
    if not widths:
        return empty
    # Every block of every window, at any offset: (block length, hash).
    by_block: dict[int, list[int]] = {}
    for w in widths:
        by_block.setdefault((w + 1) // 2, []).append(w)
    suspects = None
    split = texts.select(*keys, words(F.col("__text")).alias("w"))
    for block, of in by_block.items():
        inside = windows.filter(F.col("width").isin(of)) \
            .select(F.explode(_hashes(F.col("window"), block)).alias("h")).distinct()
        inside = broadcast_if_small(stored(inside, "item_blocks"), F.lit(16))
        found = split.select(*keys, F.explode(_blocks(F.col("w"), block)).alias("h")) \
            .join(inside, "h", "left_semi").select(*keys)
        suspects = found if suspects is None else suspects.unionByName(found)
    suspects = stored(suspects.distinct(), "suspects")
    small = broadcast_if_small(suspects, F.coalesce(F.octet_length("__id"), F.lit(0)) + F.lit(24))
    held = texts.join(small.withColumnsRenamed({"__id": "__i", "__text_hash": "__h"}),
                      F.col("__id").eqNullSafe(F.col("__i")) & F.col("__text_hash").eqNullSafe(F.col("__h")),
                      "left_semi").select(*keys, words(F.col("__text")).alias("w"))
    distinct_windows = windows.select("window", "width").distinct()
    found = None
    for w in widths:
        mine = distinct_windows.filter(F.col("width") == w).select(
            "window", _hash(F.col("window"), F.lit(0), w).alias("h"))
        mine = broadcast_if_small(stored(mine, "windows"), F.octet_length(F.array_join("window", " ")) + F.lit(32))
        at = held.filter(F.size("w") >= w).select(*keys, F.posexplode(_windows(F.col("w"), w))) \
            .select(*keys, "pos", F.col("col.h").alias("h"), F.col("col.s").alias("s")) \
            .join(mine, "h").filter(F.col("s") == F.col("window")) \
            .select(*keys, "pos", F.lit(w).alias("width"), "window")
        found = at if found is None else found.unionByName(at)
    found = stored(found, "window_hits")
    positions = found.groupBy(*keys).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set(
        F.sequence(F.col("pos"), F.col("pos") + F.col("width") - F.lit(1)))))).alias("hit"))
    named = found.select(*keys, "window").distinct().join(windows.select("window", "item_id"), "window") \
        .groupBy(*keys).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    return positions.alias("p").join(named.alias("n"), same[0] & same[1]) \
        .select("p.__id", "p.__text_hash", "hit", "items")


def scan(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``n_words``, ``hit`` (word positions) and ``items``.

    A null or empty text has no words and no hits; items without words have no
    windows; repeated rows each get their result; a null id is an id like any
    other; with an empty benchmark nothing is hit; an empty table gives an empty
    result. Names of the added columns must not be among ``keep``.
    """
    text = F.col(text_col).cast("string")
    found = hits(docs, bench, id_col, text_col, item_col) \
        .withColumnsRenamed({"__id": "__i", "__text_hash": "__h", "hit": "__hit", "items": "__items"})
    out = docs.select(*(keep if keep is not None else docs.columns),
                      F.size(words(text)).cast("bigint").alias("n_words"),
                      F.col(id_col).cast("string").alias("__id"), F.xxhash64(text).alias("__text_hash"))
    return out.join(found, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__text_hash") == F.col("__h")), "left") \
        .withColumn("hit", F.coalesce("__hit", F.array().cast("array<int>"))) \
        .withColumn("items", F.coalesce("__items", F.array().cast("array<string>"))) \
        .drop("__id", "__text_hash", "__i", "__h", "__hit", "__items")


def remove_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Cut the hit words (and what stands between two hit words in a row) out of
    the texts of ``scan``'s rows; the rest of a text stays as it is."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Words and gaps by turns: a gap (perhaps empty), a word, a gap, ..., a gap.
    word = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
    gaps, own = F.split(text, word), F.regexp_extract_all(text, F.lit(f"({word})"), F.lit(1))
    hit = F.map_from_arrays("hit", F.array_repeat(F.lit(True), F.size("hit")))

    def piece(gap: Column, i: Column) -> Column:
        before, after = F.coalesce(hit[i - 1], F.lit(False)), F.coalesce(hit[i], F.lit(False))
        return F.concat(F.when(before & after, F.lit("")).otherwise(gap),
                        F.when(after, F.lit("")).otherwise(F.coalesce(F.get(own, i), F.lit(""))))

    cut = F.array_join(F.transform(gaps, piece), "")
    return df.withColumn(text_col, F.when(F.size("hit") > 0, cut).otherwise(F.col(text_col)))
