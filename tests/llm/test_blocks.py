"""Groups of near copies are decided inside their blocks: pairs that do not link are never rows."""

import random

import numpy as np
import pandas as pd
import pytest

from test_minhash import expected, frame
from tidelog.llm import blocks, minhash, ngram_join


def near_copies(seed, groups=4, size=90):
    """Copies of a base that are mostly too far from it and from each other to link."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(150)]
        for k in range(size):
            w = list(base)
            for p in rng.sample(range(150), rng.randint(1, 9)):
                w[p] = f"n{g}_{k}_{p}"
            rows.append((1000 * g + k, " ".join(w)))
    return rows + [(9000, rows[0][1]), (None, rows[1][1]), (9001, None), (9002, "")]


@pytest.mark.parametrize("piece", [1024, 20])
@pytest.mark.parametrize("module,run", [(minhash, "near_duplicates"), (ngram_join, "similar")])
def test_rows_of_blocks_grow_with_their_members(spark, monkeypatch, module, run, piece):
    made, links = [], blocks.links

    def counted(members, *rest):
        out = links(members, *rest)
        made.append((out.count(), members.count()))
        return out

    monkeypatch.setattr(blocks, "links", counted)
    monkeypatch.setattr(module, "BLOCK", piece)
    rows = near_copies(5)
    got = getattr(module, run)(frame(spark, rows), 3, 85)
    columns = ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=repr) == \
        sorted((e[:3] for e in expected(rows, 3, 85)), key=repr)
    (n_links, n_members), = made
    assert 0 < n_links <= n_members


def test_shared_values():
    rng = np.random.default_rng(2)
    for _ in range(50):
        x, y = (np.unique(rng.integers(0, 300, rng.integers(0, 200)).astype(np.uint64)) for _ in "xy")
        assert blocks.n_shared(x, y) == len(np.intersect1d(x, y))


def test_blocks_that_span_batches_are_met_whole():
    rows = pd.DataFrame({"hub": list("aaaabbbc"), "span": [1] * 8, "i": [0, 0, 0, 1, 0, 0, 0, 0], "j": [0] * 3 + [1] + [0] * 4,
                         "at": range(8)})
    for cut in range(1, 8):
        seen = []
        run = blocks._whole_blocks(lambda r, first: seen.extend(np.split(r["at"].to_numpy(), np.flatnonzero(first)[1:])) or r)
        list(run(iter([rows.iloc[:cut], rows.iloc[cut:]])))
        assert [s.tolist() for s in seen] == [[0, 1, 2], [3], [4, 5, 6], [7]]
