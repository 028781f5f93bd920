"""What Python workers and readers hold at once, and what workers keep between tasks."""

import gc
import weakref

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidelog.llm import blocks, byte_bpe, common, ngram_join, toxicity
from tidelog.llm.queries import bpe_files


def test_batches_of_long_texts_are_bounded_in_bytes(spark):
    common.small_batches(spark)

    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"n": [len(b)], "chars": [int(b["text"].str.len().sum())]})

    long = spark.range(0, 600, 1, 1).select(F.repeat(F.lit("abcdefgh"), 1000).alias("text"))
    got = long.mapInPandas(sizes, "n int, chars bigint").collect()
    assert sum(r.n for r in got) == 600
    assert max(r.chars for r in got) <= (1 << 19) + 8000
    short = spark.range(0, 2500, 1, 1).select(F.col("id").cast("string").alias("text"))
    assert [r.n for r in short.mapInPandas(sizes, "n int, chars bigint").collect()] == [1000, 1000, 500]
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 1024


def test_a_worker_gives_back_after_a_task_is_freed(monkeypatch):
    seen = []

    def run(batches):
        held = np.zeros(10)
        seen.append(weakref.ref(held))
        for b in batches:
            yield b

    monkeypatch.setattr(common, "give_back", lambda: seen.append(seen[0]() is None))
    assert list(common.lean(run)(iter([1, 2]))) == [1, 2]
    assert seen[1:] == [True]
    seen.clear()
    rows = common.lean(run)(iter([1, 2]))      # a task that needs no more rows
    assert next(rows) == 1
    rows.close()
    gc.collect()
    assert seen[1:] == [True]


class Rows:
    """Stands for a table; keeps the functions that Spark would run."""

    def __init__(self):
        self.runs = []

    def select(self, *columns):
        return self

    filter = groupBy = agg = repartition = distinct = select

    def mapInPandas(self, run, schema):
        self.runs.append(run)
        return self

    def toPandas(self):
        return pd.DataFrame({"chunk": [], "data": []})


def test_workers_of_the_pipeline_give_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    rows = Rows()
    ngram_join.cell_counts(rows, 3)
    assert len(rows.runs) == 2
    for run in rows.runs:
        list(run(iter([])))
    assert len(calls) == 2
    for fn in (toxicity.presence_counts, toxicity.fit, toxicity.score, ngram_join._records, ngram_join.whole_sets,
               ngram_join._sketch_filter, blocks.near_members, blocks.links, byte_bpe.encode_decode):
        assert "lean" in fn.__code__.co_names, fn.__name__


def test_caches_of_a_task_are_bounded():
    path, pattern = bpe_files()
    vocab = byte_bpe.read_ranks(path)
    codec = byte_bpe.Codec(byte_bpe.model_bytes(vocab), vocab, pattern)
    for start in range(0, 300_000, 10_000):
        text = " ".join(f"q{i:x}zx" for i in range(start, start + 10_000))
        assert codec.decode(codec.encode(text)) == text.encode()
        assert len(codec.cache) <= len(codec.whole) + 200_000 + 1
    known = ngram_join._WordHashes()
    for i in range(150_000):
        known[b"%d" % i]
    assert len(known) <= 1 << 16
