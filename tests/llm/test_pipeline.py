"""The pipeline, stage by stage, against a brute-force version on a small fixture with
copies, near copies, a benchmark passage, personal data, nulls, empty and repeated rows."""

import base64
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import toxicity

corpus_pipeline = pytest.importorskip("corpus_pipeline")
P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = ["tree", "river", "stone", "cloud", "lamp", "Straße", "field", "window", "paper", "garden"]
FOUL = ["grubworm", "vilesnout", "dungface", "slimeheel"]


def _text(rng, n, more=()):
    words = [rng.choice(VOCAB) + rng.choice("abcdefghij") for _ in range(n)]
    for w in more:
        words.insert(rng.randrange(len(words)), w)
    return " ".join(words)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(5)
    text = {i: _text(rng, 40) for i in range(60)}
    text |= {i: _text(rng, 40, FOUL * 2) for i in range(60, 90)}
    labels = [(i, int(i >= 60), 1) for i in text] + [(None, 1, 1), (7, None, 1)]
    item = _text(rng, 12)
    text |= {100: text[1], 101: text[2].rsplit(" ", 1)[0] + " changed", 102: text[2] + " one more",
             110: text[4] + " " + item + " " + text[5], 111: _text(rng, 30) + " " + " ".join(item.split()[:9]),
             120: _text(rng, 20) + " write to ann.lee7@mail.example today", 121: "10.2.3.44 is up; 10.2.3.444 is not",
             130: None, 131: "", 132: " \n ", 133: "tree", 134: "tree"}
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in text.items()]
    rows += [rows[3], (None, _text(rng, 25), None, None, None)]
    root = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def _toxic(spark, docs, root, rows):
    model = toxicity.train(docs, spark.read.parquet(f"{root}/labels.parquet"), F.lit(True))
    return [r for r in rows if model.score(r.text) < 0.5]


def _near(rows):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        n = min(5, len(words))
        return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()

    rows = list(dict.fromkeys(rows))
    known = {r.doc_id: shingles(r.text) for r in rows if r.doc_id is not None}
    least = {i: i for i in known}
    while True:
        after = {i: min(least[j] for j in known
                        if i == j or (known[i] and 100 * len(known[i] & known[j]) >= 80 * len(known[i] | known[j])))
                 for i in known}
        if after == least:
            return [r for r in rows if r.doc_id is None or least[r.doc_id] == r.doc_id]
        least = after


def _leaks(rows, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))

    windows = {tuple(w[s:s + 10]) for w in map(words, items) for s in range(len(w) - 9)}
    return [r for r in rows
            if not any(tuple(words(r.text)[s:s + 10]) in windows for s in range(len(words(r.text)) - 9))]


def _clean(text):
    if text is None:
        return None
    text = re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "[EMAIL]", text)
    return re.sub(r"[0-9]+(\.[0-9]+){3}",
                  lambda m: "[IP]" if all(int(p) <= 255 for p in m.group().split(".")) else m.group(), text)


def test_stages(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    items = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == \
        ["toxicity", "near_duplicates", "decontamination", "pii", "byte_bpe"]
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, tables).write.parquet(out)
        after = spark.read.parquet(out)
        got = after.collect()
        ids = {r.doc_id for r in got}
        if name == "toxicity":
            want = _toxic(spark, docs, tables, before)
            assert not ids & set(range(60, 90)) and set(range(60)) <= ids
        elif name == "near_duplicates":
            want = _near(before)
            assert not ids & {100, 101, 102, 134} and {1, 2, 3, 130, 131, 132, 133, None} <= ids
        elif name == "decontamination":
            want = _leaks(before, items)
            assert 110 not in ids and 111 in ids
        elif name == "pii":
            assert after.columns == columns
            assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in got) == Counter(
                (r.doc_id, _clean(r.text), r.lang, r.source, None if r.text is None else len(_clean(r.text)))
                for r in before)
            text = {r.doc_id: r.text for r in got}
            assert "[EMAIL]" in text[120] and text[121] == "[IP] is up; 10.2.3.444 is not"
        else:
            path = P.path("byte_bpe_multi_50k.tiktoken")
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
            enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
            assert all(r.round_trip for r in got)
            assert Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in got) == Counter(
                (r.doc_id, len(t), np.array(t, dtype="<u4").tobytes())
                for r in before for t in [enc.encode_ordinary(r.text or "")])
        if name not in ("pii", "byte_bpe"):
            assert after.columns == columns
            assert Counter(got) == Counter(want)
        docs, before = after, got
    whole = corpus_pipeline.run(spark, tables).collect()
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in whole) == \
        Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in before)


def test_empty_documents(spark, tables, tmp_path):
    docs = spark.createDataFrame([], DOCUMENTS)
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, tables).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.count() == 0
