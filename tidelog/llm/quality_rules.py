"""Quality rules by distribution divergence.

Every text is compared with the reference of its language in two histograms:

* character classes (``CLASSES``), and
* common words: the ``COMMON_WORDS`` most common words of the language plus one
  cell for all other words.

The distance is the square root of the Jensen-Shannon divergence (base 2), 0 to
1. A text fails when a distance exceeds its limit; texts below the minimum
lengths are not judged by that histogram (a short text has no stable one).

References cover all rows: a reference is the mean of the documents' own
histograms, so one long text weighs no more than a short one. Means are
kept as whole millionths and counts, so they do not depend on the order of
summation. Every word of every language is counted: workers add up the rows of a
batch, Spark the batches of a word, and only the common words of each language
are kept.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import BROADCAST_MAX_BYTES, Kept, small_batches, stored

CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other_ascii", "beyond_ascii")
COMMON_WORDS = 50
UNIT = 1_000_000
# Sums that a worker holds before it hands them on.
HELD = 500_000

# Limits and minimum lengths of the two histograms.
CHAR_LIMIT, WORD_LIMIT = 0.26, 0.34
MIN_CHARS, MIN_WORDS = 300, 100

WINDOW = 8
SYMBOLS = "#*$%&|<>"


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other_ascii"), dtype=np.uint8)
    table[128:] = CLASSES.index("beyond_ascii")
    for name, chars in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
                        ("space", [32, *range(9, 14)]), ("stop", map(ord, ".,;:!?'\"()-")),
                        ("symbol", map(ord, SYMBOLS))):
        table[list(chars)] = CLASSES.index(name)
    return table


CLASS_OF = _class_table()


def char_counts(data: bytes) -> np.ndarray:
    """Characters of each class (a multi-byte character counts once)."""
    raw = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    raw[128:192] = 0  # continuation bytes
    return np.bincount(CLASS_OF, weights=raw, minlength=len(CLASSES))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence in bits."""
    m = (p + q) / 2

    def kl(x):
        on = x > 0
        return float((x[on] * np.log2(x[on] / m[on])).sum())

    return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    word_chars = sum(len(w.decode()) for w in words) if not text.isascii() else sum(map(len, words))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = Counter(line for line in text.split("\n") if line.encode().strip())
    return word_chars, n_symbols, sum(lines.values()) - len(lines), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 8-word windows that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    # Exact ranks of windows, doubled in length three times (1, 2, 4, 8): no hashing.
    rank, width = code, 1
    while width < WINDOW:
        pair = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        rank = np.unique(pair, return_inverse=True)[1]
        width *= 2
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return int((np.cumsum(edge) > 0).sum())


def _language(lang) -> str:
    return lang if isinstance(lang, str) else ""


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of the documents' histograms, as (lang, kind, key, n) of kinds doc, class and word."""

    def rows(total):
        return pd.DataFrame([(*k, v) for k, v in total.items()], columns=["lang", "kind", "key", "n"])

    total: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            lang, data = _language(lang), text.encode()
            tokens = data.split()
            if not tokens:
                continue
            classes = char_counts(data)
            total[lang, "doc", ""] += 1
            for name, n in zip(CLASSES, classes):
                total[lang, "class", name] += round(UNIT * n / classes.sum())
            for w, n in Counter(tokens).items():
                total[lang, "word", w.decode()] += round(UNIT * n / len(tokens))
            if len(total) > HELD:
                yield rows(total)
                total = Counter()
    yield rows(total)


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang`` and ``ref`` (array of kind, key, n: the documents, the class sums and
    the ``COMMON_WORDS`` largest word sums) over all rows. A null language is the empty one."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")) \
        .filter(F.length("text") > 0)
    summed = texts.mapInPandas(_sums, "lang string, kind string, key string, n bigint") \
        .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    # The first of each part of a language, then of the language: no task sorts a language's words.
    summed = summed.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(64)))
    for keys in (["lang", "kind", "part"], ["lang", "kind"]):
        top = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "key"))
        summed = summed.withColumn("place", top).filter(F.col("place") <= COMMON_WORDS).drop("place")
    return summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("kind", "key", "n"))).alias("ref"))


def reference(ref) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(common words, word histogram, class histogram) of one language's sums."""
    docs_n = next(n for kind, _, n in ref if kind == "doc")
    cells = {key: n / docs_n / UNIT for kind, key, n in ref if kind == "class"}
    classes = np.array([cells.get(c, 0.0) for c in CLASSES])
    common = sorted((key.encode(), n / docs_n / UNIT) for kind, key, n in ref if kind == "word")
    hist = np.array([x for _, x in common] + [max(0.0, 1 - sum(x for _, x in common))])
    return [w for w, _ in common], hist / hist.sum(), classes / classes.sum()


def judge(docs: DataFrame, keep: list[str], char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT,
          min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS,
          lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``char_distance``, ``word_distance``, ``kept``.

    A null or empty text has no words: all counts 0, ``base_failed``, not kept,
    distances null. A distance is null where its minimum length is not met.
    Repeated rows are judged each; an empty table gives an empty result;
    columns not named are not read.
    """
    refs = stored(references(docs, lang_col, text_col), "references")
    # Sums as text, so that a language's cross to the workers as one string.
    refs = refs.select(F.col("lang").alias("__lang"), F.to_json("ref").alias("__ref"))
    size = refs.agg(F.sum(F.octet_length("__ref")).alias("b")).first()["b"] or 0
    few = size <= BROADCAST_MAX_BYTES
    shared = docs.sparkSession.sparkContext.broadcast({r["__lang"]: r["__ref"] for r in refs.collect()} if few else {})
    kept = Kept(docs, keep)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance")
    out = kept.schema(", ".join([*(f"__{n} bigint" for n in names[:5]), *(f"__{n} double" for n in names[5:])]))

    known: dict[str, tuple] = {}

    def of(lang, own):
        if lang not in known:
            text = own if own is not None else shared.value.get(lang)
            if len(known) > 5_000:
                known.clear()
            known[lang] = reference([(x["kind"], x["key"], x["n"]) for x in json.loads(text)]) if text else None
        return known[lang]

    def row(lang, text, own):
        if not text:
            return (0, 0, 0, 0, 0, None, None)
        data = text.encode()
        words = data.split()
        chars = words_ = None
        ref = of(_language(lang), own)
        if ref and len(text) >= min_chars and words:
            classes = char_counts(data)
            chars = js_distance(classes / classes.sum(), ref[2])
        if ref and len(words) >= min_words:
            count = Counter(words)
            common = [count[w] for w in ref[0]]
            words_ = js_distance(np.array(common + [len(words) - sum(common)]) / len(words), ref[1])
        return (len(words), *base_counts(text, words), chars, words_)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [row(*x) for x in zip(batch.pop("__lang"), batch.pop("__text"), batch.pop("__ref"))]
            for i, n in enumerate(names):
                batch[f"__{n}"] = pd.array([r[i] for r in rows], dtype="Int64" if i < 5 else "Float64")
            yield batch

    rows_in = docs.select(*kept.sent, F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("__lang"),
                          F.col(text_col).cast("string").alias("__text"))
    if few:
        rows_in = rows_in.withColumn("__ref", F.lit(None).cast("string"))
    else:
        # Languages are joined in pieces, so that none goes to one task.
        pieces = 64
        spread = refs.withColumn("__piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
        rows_in = rows_in.withColumn("__piece", F.pmod(F.xxhash64("__text"), F.lit(pieces)).cast("int")) \
            .join(spread, ["__lang", "__piece"], "left").select(*[F.col(c) for c in keep], "__lang", "__text", "__ref")
    df = kept.back(rows_in.mapInPandas(run, out))
    df = df.withColumnsRenamed({f"__{n}": n for n in names})
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    far = (F.coalesce(F.col("char_distance"), F.lit(0.0)) > char_limit) \
        | (F.coalesce(F.col("word_distance"), F.lit(0.0)) > word_limit)
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)
