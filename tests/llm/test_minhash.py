"""Bottom-k near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest

from tidelog.llm import minhash

SCHEMA = "doc_id long, text string, n long, signature string, component string, kept int"
BIG = 9007199254740993


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "s", "c", 3) for i, t in rows], SCHEMA).repartition(3)


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < width else frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def expected(rows, width, percent):
    """(id, set size, component id, kept) of every row, by comparing all pairs of sets."""
    sets = sorted({shingles(t, width) for _, t in rows} - {frozenset()}, key=lambda s: sorted(s))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    at = {s: k for k, s in enumerate(sets)}
    ids = {}
    for i, t in rows:
        s = shingles(t, width)
        if s and i is not None:
            r = root(at[s])
            ids[r] = min(i, ids.get(r, i))
    out = []
    for i, t in rows:
        s = shingles(t, width)
        c = ids.get(root(at[s])) if s else i
        out.append((i, len(s), c, i == c))
    return sorted(out, key=repr)


def answers(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, width, percent):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 120))) for _ in range(40)]
    for t in texts[:25]:
        for _ in range(3):
            w = t.split()
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w))
    texts += texts[:4] + ["", None, " \n\t", "one", "ONE", "one two", "a " * 6000, "\x1c\x85 odd　 spaces"]
    rows = [(100 + i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[3]), (None, None), (None, "alone here now"), rows[5], rows[5], (BIG, texts[7]), (BIG + 1, "two words")]
    assert answers(minhash.near_duplicates(frame(spark, rows), width, percent)) == expected(rows, width, percent)


def test_one_id_with_several_texts(spark):
    a, b = "alpha beta gamma delta epsilon zeta eta theta", "stone river cloud lamp house tree wort sky"
    near = " ".join([b] * 1 + ["sea"])
    for x, y in ((a, b), (b, a)):
        rows = [(1, x), (1, y), (2, b), (3, near), (4, a), (5, near + " " + near)]
        assert answers(minhash.near_duplicates(frame(spark, rows), 3, 80)) == expected(rows, 3, 80)


def test_large_group_of_near_copies(spark):
    """Copies that often differ more from each other than from their base, and a passage that all texts share."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    shared = [f"p{i}" for i in range(60)]
    rows = []
    for k in range(1300):
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(150)] = f"n{k}_{rng.randint(0, 3)}"
        rows.append((k, " ".join(w)))
    rows += [(2000 + k, " ".join(shared + [f"u{k}_{j}" for j in range(50)])) for k in range(300)]
    assert answers(minhash.near_duplicates(frame(spark, rows), 3, 85)) == expected(rows, 3, 85)


def test_empty_table_and_no_words(spark):
    assert minhash.near_duplicates(frame(spark, []), 3, 85).count() == 0
    rows = [(1, ""), (2, None), (2, " "), (None, "")]
    assert answers(minhash.near_duplicates(frame(spark, rows), 3, 85)) == expected(rows, 3, 85)


def test_bounds_of_the_sketch():
    """The union sketch counts what both hold, and a linked pair shares at least ``least_shared``."""
    rng = np.random.default_rng(5)
    m = minhash.least_shared(85)
    assert 30 < m < 54 and minhash.least_shared(100) == minhash.K
    for _ in range(200):
        union = np.unique(rng.integers(0, 2**64 - 1, size=rng.integers(5, 400), dtype=np.uint64))
        common = rng.random(len(union)) < 0.93
        x, y = union[common | (rng.random(len(union)) < 0.5)], union[common]
        if not len(y):
            continue
        size, shared = minhash.union_shared(minhash._padded([x[:minhash.K].tobytes()]), minhash._padded([y[:minhash.K].tobytes()]))
        first = np.unique(np.concatenate([x, y]))[:minhash.K]
        assert size[0] == len(first) and shared[0] == np.isin(first, np.intersect1d(x, y)).sum()
        if 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y)):
            assert shared[0] >= min(minhash.least_of(len(x), 85), minhash.least_of(len(y), 85))
