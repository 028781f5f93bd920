"""Sharding by a Feistel permutation over global row numbers.

Row ``i`` of ``n`` goes to position ``p = permutation(i)``; shard ``p % shards``
and slot ``p // shards``, so shard sizes differ by at most one (law ``rows``)
and the slots of a shard are 0, 1, 2, ... without gaps. Any row's place can be
computed from its row number, the row count and the key alone.

The permutation is a Feistel network over ``Z_a x Z_b`` with
``a = ceil(sqrt(n))`` and ``b = ceil(n / a)``; positions at or beyond ``n`` walk
the cycle until they are below ``n``. There are fewer than ``a`` such
positions, and a walk visits each at most once, which bounds it exactly.

Global row numbers come without a global window: rows are ordered by the md5
of (id, text), whose first hex digits are the buckets. Per-bucket counts give
bucket offsets; a window inside one bucket (about a million rows at most)
gives the rest. Buckets are values of the row, so a retried task numbers its
rows alike. Rows equal in id and text are interchangeable.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored

ROUNDS = 8
# Two primes below 2**31: products of two residues stay below 2**62.
P1, P2 = 2147483647, 2147483629
M1, M2 = 1103515245, 1226874159
BUCKET_ROWS = 1_000_000


def round_keys(seed: int) -> list[int]:
    """One key per half round, from the seed."""
    keys, x = [], seed % P1
    for _ in range(ROUNDS):
        x = (x * 48271 + 11) % P1
        keys.append(x)
    return keys


def sides(n: int) -> tuple[int, int]:
    """The two sides of the smallest near-square grid with at least ``n`` cells."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def permute_int(i: int, n: int, seed: int) -> int:
    """The permutation for one row number, in plain Python (reference and lookups)."""
    a, b = sides(n)
    v = i
    while True:
        for k, key in enumerate(round_keys(seed)):
            left, right = divmod(v, b)
            if k % 2 == 0:
                left = (left + ((right * M1 + key) % P1 * M2 + key) % P2) % a
            else:
                right = (right + ((left * M1 + key) % P1 * M2 + key) % P2) % b
            v = left * b + right
        if v < n:
            return v


def _feistel(v: Column, a: int, b: int, seed: int) -> Column:
    keys = F.array(*[F.struct(F.lit(k % 2 == 0).alias("left"), F.lit(key).cast("bigint").alias("key"))
                     for k, key in enumerate(round_keys(seed))])

    def mix(x: Column, key: Column) -> Column:
        return ((x * F.lit(M1) + key) % F.lit(P1) * F.lit(M2) + key) % F.lit(P2)

    def step(v: Column, k: Column) -> Column:
        left, right = _div(v, b), v % F.lit(b)
        return F.when(k["left"], (left + mix(right, k["key"])) % F.lit(a) * F.lit(b) + right) \
            .otherwise(left * F.lit(b) + (right + mix(left, k["key"])) % F.lit(b))

    return F.aggregate(keys, v, step)


def _div(v: Column, b: int) -> Column:
    return ((v - v % F.lit(b)) / F.lit(b)).cast("bigint")


def permutation(row: Column, n: int, seed: int) -> Column:
    """``permute_int`` as a column expression."""
    a, b = sides(n)
    first = _feistel(row.cast("bigint"), a, b, seed)
    outside = a * b - n
    if outside == 0:
        return first
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(outside)), first,
        lambda p, _: F.when(p < F.lit(n), p).otherwise(_feistel(p, a, b, seed)))
    return F.when(first < F.lit(n), first).otherwise(walk)


def row_numbers(df: DataFrame, order_key: str, out: str, n: int) -> DataFrame:
    """Gapless numbers 0..n-1 in the order of the hex column ``order_key``."""
    digits = max(3, math.ceil(math.log(max(1, n / BUCKET_ROWS), 16)))
    with_bucket = df.withColumn("__bucket", F.substring(order_key, 1, digits))
    counts = with_bucket.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    offsets = counts.select("__bucket", (F.sum("__rows").over(
        Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        - F.col("__rows")).alias("__offset"))
    inside = F.row_number().over(Window.partitionBy("__bucket").orderBy(order_key))
    return with_bucket.withColumn("__inside", inside).join(offsets, "__bucket") \
        .withColumn(out, F.col("__offset") + F.col("__inside") - F.lit(1)) \
        .drop("__bucket", "__inside", "__offset")


def assign_shards(docs: DataFrame, n_shards: int, seed: int = 20240229,
                  id_col: str = "doc_id", text_col: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: the id) plus ``size``, ``text_crc32``, ``row_number``,
    ``position``, ``shard`` and ``slot``.

    A null text has size 16 and the crc of no bytes (0); a null id is an id
    like any other; repeated rows each get a place of their own; an empty
    table gives an empty result. Only digests of a text are shuffled.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = stored(docs.select(
        *(keep if keep is not None else [id_col]),
        (F.octet_length(text) + F.lit(16)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text)).alias("__key"),
    ), "shard_rows")
    n = narrow.count()
    place = permutation(F.col("row_number"), n, seed)
    return row_numbers(narrow, "__key", "row_number", n).drop("__key") \
        .withColumn("position", place) \
        .withColumn("shard", (F.col("position") % F.lit(n_shards)).cast("int")) \
        .withColumn("slot", _div(F.col("position"), n_shards))
