"""Counted cells leave a Python worker in small batches."""

import numpy as np
import pandas as pd
import pytest

from tidelog.llm import toxicity


class Stop(Exception):
    pass


class Sample:
    """Stands for the sample; keeps the function that Spark would run."""

    def select(self, *columns):
        return self

    def mapInPandas(self, run, schema):
        self.run = run
        raise Stop


def test_counted_cells_leave_in_small_batches():
    sample = Sample()
    with pytest.raises(Stop):
        toxicity.presence_counts(sample)
    rng = np.random.default_rng(4)
    texts = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6000)) for _ in range(20)]
    batches = list(sample.run(iter([pd.DataFrame({"text": texts[:12], "label": 0}), pd.DataFrame({"text": texts[12:], "label": 1})])))
    assert max(map(len, batches)) <= 1 << 16
    got = pd.concat(batches)
    for y, own in ((0, texts[:12]), (1, texts[12:])):
        cells, n = np.unique(np.concatenate([np.unique(np.concatenate(list(toxicity.grams(t)))) for t in own]), return_counts=True)
        mine = got[(got["label"] == y) & (got["cell"] >= 0)]
        assert mine["cell"].tolist() == cells.tolist() and mine["n"].tolist() == n.tolist()
        assert got[(got["label"] == y) & (got["cell"] < 0)]["n"].tolist() == [len(own)]
