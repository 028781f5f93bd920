"""Dual-tree search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidelog.llm import lexical_search as ls

SCHEMA = "doc_id long, text string, n long, terms string, item_id string, score int"
BIG = 9007199254740993


def frames(spark, docs, items):
    return spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in docs], SCHEMA).repartition(4), \
        spark.createDataFrame([(i, t, 3) for i, t in items], "item_id string, text string, doc_id int")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def expected(docs, items, k):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in held:
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def answers(spark, docs, items, k=10):
    got = ls.search(*frames(spark, docs, items), k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(4)
    vocab = [f"Wort{i}" for i in range(150)] + ["été", "中文", "x1"]
    out = [(i, " ".join(rng.choices(vocab, weights=[1 / (j + 1) for j in range(len(vocab))], k=rng.randint(1, 50)))) for i in range(900)]
    out += [(2000 + i, out[i][1]) for i in range(60)] + [(3000 + i, "twin text, wort140 wort141!") for i in range(90)]
    out += [(5000, "Wort7 " * 60_000), (5001, ""), (5002, None), (5003, " .,;"), (None, "twin wort140"), (None, None)]
    return out + [out[3], out[3], (BIG, "lone wort149 word"), (BIG + 1, "lone wort149 word"), (BIG - 1, "lone wort149 word")]


@pytest.fixture(scope="module")
def items(docs):
    rng = random.Random(9)
    out = [(f"q{i}", " ".join(docs[rng.randrange(900)][1].split()[:rng.randint(1, 30)])) for i in range(40)]
    out += [("twin", "Twin text wort140"), ("lone", "LONE"), ("none", "absent words"), ("empty", ""), ("null", None), (None, "wort3 twin")]
    return out + [out[0]]


@pytest.mark.parametrize("k", [1, 10])
def test_against_brute_force(spark, docs, items, k, monkeypatch):
    monkeypatch.setattr(ls, "SEED_ROWS", 200)
    assert answers(spark, docs, items, k) == expected(docs, items, k)


def test_several_batches_of_items(spark, docs, items, monkeypatch):
    monkeypatch.setattr(ls, "BATCH_TERMS", 40)
    assert answers(spark, docs[:200], items[:12]) == expected(docs[:200], items[:12], 10)


def test_empty_tables(spark, docs, items):
    assert answers(spark, [], items) == [] and answers(spark, docs[:9], []) == []
    assert answers(spark, [(1, None), (2, "")], items) == []


def test_bounds_prune_whole_leaves():
    """Far documents are never scored once an item has its best."""
    weights = np.eye(16) * 1000
    tree = ls.ItemTree(weights, 1)
    best = ls.Best(16, 1, np.zeros(16))
    n = 1024
    term = np.arange(n) % 16
    value = np.where(np.arange(n) < 16, 900, 10)
    scored = ls.search_chunk(tree, best, np.arange(n), term, value, np.arange(n), [str(i) for i in range(n)])
    assert [h[0][0] for h in best.heaps] == [900_000] * 16 and scored < 16 * 2
