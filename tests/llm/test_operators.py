"""Training-data operators against brute force, on small fixtures with nulls, empty
and repeated rows, ties, empty tables and extra columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import (byte_bpe, decontamination, html_extraction, ngram_join, pii, quality_rules, quality_trees,
                         sharding, token_rollup, toxicity)
from tidelog.llm.queries import bpe_files

SCHEMA = "doc_id long, text string, lang string, source string, label int, words string, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, 1, "x", "y") for i, t, lang, src in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    vocab = ["wort", "haus", "Été", "tree", "river", "the", "of", "and", "is", "stone", "cloud", "lamp", "x1"]
    texts = [" ".join(rng.choice(vocab) + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    near = []
    for t in texts[:12]:
        words = t.split()
        words[len(words) // 2] = "changed"
        near.append(" ".join(words))
    texts += near + texts[:5] + ["", None, "   \n\t", "one", "One", "one two", "a " * 4000, "\x1c\x85 odd　 spaces"]
    out = [(i, t, "en" if i % 3 else None, f"s{i % 2}") for i, t in enumerate(texts)]
    return out + [(None, "one two", "de", None), (None, None, None, None), out[3], out[3]]


def test_sharding(spark, rows):
    got = sharding.assign_shards(frame(spark, rows), 7).collect()
    n = len(rows)
    assert sorted(r.position for r in got) == list(range(n))
    assert all(sharding.permute_int(r.row_number, n, 20240229) == r.position for r in got)
    for shard in range(7):
        slots = sorted(r.slot for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots))) and len(slots) in (n // 7, n // 7 + 1)
    text = {i: t or "" for i, t, *_ in rows}
    for r in got:
        if r.doc_id is not None:
            assert r.size == len(text[r.doc_id].encode()) + 16
            assert r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
    assert sharding.assign_shards(frame(spark, []), 7).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 17, 100, 1000])
def test_permutation_is_one(n):
    assert sorted(sharding.permute_int(i, n, 5) for i in range(n)) == list(range(n))


def test_byte_bpe(spark, rows):
    tiktoken = pytest.importorskip("tiktoken")
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    extra = [(900, "<|endoftext|> 中文 🙂\x00\n\n  end ", "en", "s"), (901, "ab" * 700_000, "en", "s")]
    df = frame(spark, rows + extra)
    got = byte_bpe.ids_array(byte_bpe.encode_decode(df.filter("doc_id < 901 OR doc_id IS NULL"), path, P.PATTERN,
                                                    ["doc_id", "text"])).collect()
    for r in got:
        want = enc.encode_ordinary(r.text or "")
        assert r.token_ids == want and r.n_tokens == len(want)
        assert bytes(r.decoded) == (r.text or "").encode()
    long = byte_bpe.encode_decode(df.filter("doc_id = 901"), path, P.PATTERN, ["text"]).first()
    assert bytes(long.decoded) == long.text.encode()
    assert byte_bpe.encode_decode(frame(spark, []), path, P.PATTERN, ["doc_id"]).count() == 0


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def test_decontamination(spark, rows):
    items = [(1, " ".join((rows[0][1] or "").split()[:14])), (2, "ONE two"), (10, "one"), (3, None), (4, "?!"),
             (5, rows[20][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.scan(frame(spark, rows), bench).collect()
    windows = defaultdict(set)
    for i, t in items:
        w = _words(t)
        k = min(10, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[s:s + k])].add(str(i))

    def want(text):
        w, hit, ids = _words(text), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in windows:
                    hit |= set(range(s, s + k))
                    ids |= windows[tuple(w[s:s + k])]
        return len(w), sorted(hit), sorted(ids)

    assert len(got) == len(rows)
    assert any(r.hit for r in got)
    for r in got:
        assert (r.n_words, list(r.hit), list(r.items)) == want(r.text)
    cut = decontamination.remove_spans(decontamination.scan(frame(spark, rows), bench)).collect()
    by_id = {r.doc_id: r for r in cut if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            left = [w for i, w in enumerate(_words(r.text)) if i not in set(r.hit)]
            assert _words(by_id[r.doc_id].text) == left
    none = decontamination.scan(frame(spark, rows), bench.limit(0))
    assert none.filter(F.size("hit") > 0).count() == 0 and none.count() == len(rows)
    assert decontamination.scan(frame(spark, []), bench).count() == 0


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (2, 50)])
def test_ngram_join(spark, rows, width, percent):
    got = ngram_join.similar(frame(spark, rows), width, percent).collect()
    assert len(got) == len(rows)

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        if not w:
            return frozenset()
        return frozenset([tuple(w)]) if len(w) < width else frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))

    sets = {i: shingles(t) for i, t, *_ in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), find(r.doc_id))
    assert {r.component_id for r in got if r.doc_id is None} == {62, None}  # "one two" has a class, null text none
    assert ngram_join.similar(frame(spark, []), width, percent).count() == 0


def test_ngram_join_large_near_copy_group(spark):
    """Copies of one text that often differ more from each other than from it, in lists of several blocks."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base)]
    for k in range(260):
        words = list(base)
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(120)] = f"n{k}_{rng.randint(0, 9)}"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sets = [{tuple(t.split()[i:i + 3]) for i in range(118)} for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    small, ngram_join.BLOCK = ngram_join.BLOCK, 40
    try:
        got = {r.doc_id: r.component_id for r in ngram_join.similar(df, 3, 90).collect()}
    finally:
        ngram_join.BLOCK = small
    assert got == {i: find(i) for i in range(len(texts))}
    assert 1 < len(set(got.values())) < len(texts)


def test_pii_base_spans(spark):
    rng = random.Random(5)
    parts = ["a", "b@", "c.d", "@", ".", "1", "2", "55", " ", "-", "+", "+1", "(", ")", "é", "4111 1111 1111 1111",
             "4111-1111", ".1.2", "300", "x@y.z", "_", "%", "🙂", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]

    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            x = int(c) * (1 + i % 2)
            total += x - 9 if x > 9 else x
        return total % 10 == 0

    def digits(v):
        return re.sub(r"\D", "", v)

    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(digits(v)) <= 19 and luhn(digits(v))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(digits(v)) <= 15)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", pii.as_text(pii.base_spans(F.col("text"))).alias("s")).collect():
        want = [f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, r.text) if ok(m.group())]
        assert r.s == ",".join(want)


def test_pii_terms_that_reveal_an_entity(spark):
    rows = [(i, f"Note {'abcdefghij'[i]}{i}: Falconer of the mill, call +49 30 1234567 today", "en", "s") for i in range(5)]
    rows += [(i, f"the note of today number {i} is about the mill", "en", "s") for i in range(5, 60)]
    rows += [(60, None, "en", "s"), (61, "", None, None), rows[0], (None, "mail a.b@c.org", "en", "s")]
    found = pii.find(frame(spark, rows), ["doc_id", "text"])
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        terms = {r.text[s.start:s.end].lower() for s in r.terms}
        assert ("falconer" in terms) == ("Falconer" in (r.text or ""))
        assert not terms & {"the", "mill", "today", "note"}
    clean = {r.doc_id: r.text for r in pii.sanitise(found).collect()}
    assert "1234567" not in clean[0] and "Falconer" not in clean[0] and "[PHONE]" in clean[0] and "mill" in clean[0]
    assert clean[None] == "mail [EMAIL]" and clean[60] is None and clean[61] == "" and clean[7] == rows[7][1]
    assert pii.find(frame(spark, []), ["doc_id"]).count() == 0


@pytest.mark.parametrize("others", [40, 1500])
def test_pii_every_pair_in_a_document_is_scored(spark, others):
    far = "the road is long and the day is short " * 20
    rows = [(i, f"Marlowe wrote this. {far} Ask a.b@c.org {'x' * (i + 1)}. {far} Yes, Marlowe did.", "en", "s") for i in range(3)]
    rows += [(9, f"Once, Yorick sees {far} x@y.org", "en", "s"), (10, None, None, None)]
    rows += [(20 + i, f"{far} a b@ Ask, wrote yes, once, this did number {i}", "en", "s") for i in range(others)]
    rows += [(5000 + i, f"note {i}: Ophelia sees +49 30 7654321, the road", "en", "s") for i in range(2)]
    rows += [(6000, "Ophelia sees, note", "en", "s"), rows[0]]
    found = pii.find(frame(spark, rows), ["doc_id", "text"]).filter(F.size("base") + F.size("terms") > 0).collect()
    assert sorted(r.doc_id for r in found) == [0, 0, 1, 2, 9, 5000, 5001]
    for r in found:
        # Three texts are evidence; one (Yorick) or two of three (Ophelia) are none, whatever the size of the corpus.
        got = [(s.kind, s.start, s.end, s.value) for s in r.terms]
        assert got == [("revealing", m.start(), m.end(), "marlowe") for m in re.finditer("Marlowe", r.text)]


def test_pii_terms_against_brute_force(spark):
    rnd = random.Random(17)
    entities = [f"u{i}@host.org" for i in range(6)]
    words = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(30)]
    texts = []
    for i in range(300):
        held = rnd.sample(entities, rnd.choice([0, 0, 1, 1, 2]))
        said = rnd.sample(words, 5) + [f"name{'abcdef'[int(e[1])]}" for e in held if rnd.random() < 0.8]
        said += [f"name{'abcdef'[rnd.randrange(6)]}"] * (rnd.random() < 0.08)
        texts.append(" ".join(rnd.sample(held + said, len(held) + len(said))))
    texts += texts[:20] + ["", None]
    of = {t: (set(re.findall(r"u[0-9]@host[.]org", t)), set(re.findall(r"[a-z]{3,}", re.sub(r"u[0-9]@host[.]org", " ", t))))
          for t in texts if t is not None}
    n, want = len(of), {t: {} for t in of}
    for c in entities:
        n_c = sum(c in e for e, _ in of.values())
        for t in set().union(*(w for _, w in of.values())):
            n_t, n_ct = sum(t in w for _, w in of.values()), sum(t in w and c in e for e, w in of.values())
            p, zz = n_ct / n_t, 1.645 ** 2
            low = (p + zz / 2 / n_t - 1.645 * (p * (1 - p) / n_t + zz / 4 / n_t ** 2) ** 0.5) / (1 + zz / n_t)
            if n_ct and low >= 0.5 and low >= 2 * n_c / n:
                for text, (e, w) in of.items():
                    if c in e and t in w:
                        want[text][t] = "revealing" if n_ct == n_t or want[text].get(t) == "revealing" else "term"
    assert sum(map(len, want.values())) > 50 and {k for w in want.values() for k in w.values()} >= {"term"}
    rows = pii.find(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), ["doc_id", "text"]).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert {s.value: s.kind for s in r.terms} == want.get(r.text, {})


def test_pii_patterns_do_not_recurse(spark):
    texts = ["7" * 1_000_000, "1 " * 500_000 + "x", "a@b" + ".c-d" * 100_000, "a\U00010400" * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.s for r in df.select(pii.as_text(pii.base_spans(F.col("text"))).alias("s")).collect()]
    assert sorted(got) == ["", "", "", f"email:0:{len(texts[2])}"]
    found = pii.found(F.col("text"), pii.TERM, F.lit(True))
    assert [r.n for r in df.filter("text like 'a\U00010400%'").select(found[0]["end"].alias("n")).collect()] == [200_000]


def test_pii_many_matches_in_one_text(spark):
    text = "".join(f"Käse u{i}@h{i % 97}.example.org, 10.0.{i % 256}.{i % 300} +49 30 {1000000 + i} " for i in range(34_000))
    df = spark.createDataFrame([(1, text), (2, "a@b.c"), (3, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.sanitise(pii.find(df, ["doc_id", "text"]).withColumn("n", F.size("base"))).collect()}
    base = re.compile(r"(u[0-9]+@h[0-9.a-z]+)|(10[.]0[.][0-9]+[.](?:[01]?[0-9]?[0-9]|2[0-4][0-9]|25[0-5])\b)|([+]49 30 [0-9]+)")
    want, n = base.subn(lambda m: "[" + ("EMAIL", "IP", "PHONE")[m.lastindex - 1] + "]", text)
    assert rows[1].n == n > 95_000 and rows[1].text == want
    assert (rows[2].text, rows[3].text) == ("[EMAIL]", None)


@pytest.mark.parametrize("group", [1, 2, 7, 256])
def test_pii_spans_replaced_in_groups(spark, monkeypatch, group):
    monkeypatch.setattr(pii, "GROUP", group)
    rng = random.Random(group)
    rows = []
    for i in range(60):
        text = "".join(rng.choice("ab é\U0001F600") for _ in range(rng.randint(0, 40)))
        spans = [sorted(rng.sample(range(len(text) + 1), 2)) for _ in range(rng.randint(0, 12))] if text else []
        rows.append((i, text, [(rng.choice(["term", "revealing", "ip"]), a, b, "") for a, b in spans]))
    df = spark.createDataFrame(rows, f"doc_id long, text string, terms array<{pii.SPAN}>") \
        .withColumn("base", F.array().cast(f"array<{pii.SPAN}>")).withColumn("blank", pii._blanked(F.col("text"), F.col("terms")))
    got = {r.doc_id: r for r in pii.sanitise(df).collect()}
    for i, text, spans in rows:
        covered = {p for _, a, b, _ in spans for p in range(a, b)}
        assert got[i].blank == "".join(" " if p in covered else c for p, c in enumerate(text))
        want, at = "", 0
        for a, b, kind in sorted((a, b, k) for k, a, b, _ in spans):
            if a >= at:
                want += text[at:a] + ("" if kind == "revealing" else f"[{kind.upper()}]")
            at = max(at, b)
        assert got[i].text == want + text[at:]


def test_ids_beside_nulls_keep_their_digits(spark):
    big = 9007199254740993
    docs = spark.createDataFrame([(big, 1, "one two", "en", float("nan")), (None, None, "three", None, None), (big + 1, 2, None, "en", 0.1)],
                                 "doc_id long, small int, text string, lang string, ratio double")
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    keep = ["doc_id", "small", "ratio"]
    toxic = toxicity.train(docs, labels, F.lit(True))
    good = quality_trees.train(docs, labels, F.lit(True))
    pages = docs.select(F.col("doc_id").alias("page_id"), "small", "ratio", F.lit("http://a.b/").alias("url"), F.col("text").alias("html"))
    ranks, pattern = bpe_files()
    for df in (toxicity.score(docs, toxic, keep), quality_trees.score(docs, good, keep), quality_rules.judge(docs, keep),
               byte_bpe.encode_decode(docs, ranks, pattern, keep), html_extraction.main_text(pages, ["page_id", *keep[1:]])):
        assert [f.dataType.simpleString() for f in df.schema.fields[:3]] == ["bigint", "int", "double"]
        assert sorted((str(r[0]), str(r[1]), str(r[2])) for r in df.collect()) == [
            (str(big), "1", "nan"), (str(big + 1), "2", "0.1"), ("None", "None", "None")]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li>News</li></ul></nav><div class="cookie-notice">We use cookies</div>
<header>Site</header><article><h1>{title}</h1><p>{a}<br>more <b>bo</b>ld &amp; &#228;<p>{b}</p>{extra}
<aside>related</aside><form><input><label>mail</label></form><section class="comments"><p>rubbish</p></section></article>
<div id="sidebar"><p>links</p></div><footer>&copy; me</footer></body></html>"""


def test_html_extraction(spark):
    pages, want = [], {}
    for i in range(12):
        extra = "<ul><li>one</li><li>two</li></ul>" if i % 3 == 0 else ""
        pages.append((i, f"http://h{i % 2}.org/{i}", PAGE.format(title=f"Title {i}", a=f"First {i}", b=f"Second\n {i}", extra=extra)))
        want[i] = f"Title {i} First {i} more bold & ä Second {i}" + (" one two" if extra else "")
    plain = "<body><div class=menu>m</div><div class='post'><p>Own text</p><table><tr><td>cell<td>two</table></div></body>"
    pages += [(20, None, plain), (21, "odd", None), (22, "http://z.org", ""), (23, "http://z.org/1", "no markup < at all"),
              (24, "http://z.org/2", "<p>un<i>clos</i>ed <!-- gone")]
    want |= {20: "Own text cell two", 21: "", 22: "", 23: "no markup < at all", 24: "unclosed"}
    df = spark.createDataFrame([(*p, "x", 1) for p in pages + pages[:2]],
                               "page_id long, url string, html string, text string, host int").repartition(4)
    got = html_extraction.main_text(df, ["page_id", "url"]).collect()
    assert len(got) == len(pages) + 2
    for r in got:
        assert (r.text, r.n_chars) == (want[r.page_id], len(want[r.page_id]))
    limit, html_extraction.BROADCAST_MAX_BYTES = html_extraction.BROADCAST_MAX_BYTES, 0
    try:
        assert {r.page_id: r.text for r in html_extraction.main_text(df, ["page_id"]).collect()} == want
    finally:
        html_extraction.BROADCAST_MAX_BYTES = limit
    assert html_extraction.main_text(df.limit(0), ["page_id"]).count() == 0


def test_wrappers_do_not_depend_on_the_order():
    pages = ["<div><p>a</p><p>b</p></div>", "<div><h2>x</h2><p>a</p></div>", "<div><p>q</p><h2>y</h2></div>", "<ul><li>1</ul>"]
    texts = set()
    for seed in range(6):
        order = random.Random(seed).sample(pages, len(pages))
        w = html_extraction.page_wrapper(order[0])
        for p in order[1:]:
            w = html_extraction.align(w, html_extraction.load(html_extraction.dump(html_extraction.page_wrapper(p))))
        texts.add(html_extraction.dump(w))
    assert len(texts) == 1
    expression = html_extraction.expression(html_extraction.load(texts.pop()))
    assert "(<h2>#</>? <p>" in expression and ")+" in expression


def _texts(pages):
    """The texts of the pages of one host."""
    wrapper = html_extraction.page_wrapper(pages[0])
    for page in pages[1:]:
        wrapper = html_extraction.align(wrapper, html_extraction.page_wrapper(page))
    roles = html_extraction.chosen(html_extraction.load(html_extraction.dump(wrapper)))
    return [html_extraction.extract(page, roles) for page in pages]


def test_html_slots_of_the_wrapper_decide():
    pages, want = [], []
    for i in range(14):
        promo = "<div class=box>Buy it</div>" if i % 2 else ""
        pages.append(f"<body class='page nav-open'><div class='sidebar-layout'><article class='post share'><h1>Title {i}</h1>"
                     f"<p>From our desk</p><p>Own {i}</p>{promo}<ul><li>item {i}</li><li>See all</li></ul></article></div></body>")
        want.append(f"Title {i} From our desk Own {i} item {i} See all")
    for n in (4, 5, 14):
        assert _texts(pages[:n]) == want[:n]
    comments = "<div class=comments><article>c1</article><article>c2</article></div>"
    assert _texts([f"<article>text</article>{comments}"]) == ["text"]


def test_html_slots_are_compared_whole():
    same = "Preamble of the licence. " * 20
    pages = [f"<body><div><p>{same}ends with {i}</p></div></body>" for i in range(7)]
    assert _texts(pages) == [f"{same}ends with {i}" for i in range(7)]
    copies = [f"<body><!-- {i} --><script>track({i})</script><h1>One</h1><p>page</p><p>only</p></body>" for i in range(7)]
    assert _texts(copies) == ["One page only"] * 7
    two = copies + ["<body><h1>Two</h1><p>page</p></body>"]
    assert _texts(two) == ["One page only"] * 7 + ["Two page"]


def test_html_constant_text_of_an_article_stays():
    pages = [f"<article><h1>Dish {i}</h1><p class=author>By Ann Lee</p><h2>Ingredients</h2><p>egg {i}</p>"
             f"<h2>Method</h2><p>stir {i}</p></article>" for i in range(6)]
    want = [f"Dish {i} By Ann Lee Ingredients egg {i} Method stir {i}" for i in range(6)]
    for n in range(1, 7):
        assert _texts(pages[:n]) == want[:n]
    bare = [f"<body><div class=top><p>Our site</p></div><h1>Dish {i}</h1><h2>Method</h2><p>stir {i}</p><p>Serve</p></body>"
            for i in range(6)]
    for n in (2, 6):
        assert _texts(bare[:n]) == [f"Dish {i} Method stir {i} Serve" for i in range(n)]
    many = html_extraction.page_wrapper("<div>" + "".join(f"<p class='{chr(97 + i % 26) * (1 + i // 26)}'>x</p>"
                                                          for i in range(2000)) + "</div>")
    node = many["c"]["div"]
    assert len(node["c"]) == 2000 and len(node["o"]) == 1999


def test_html_elements_nest_to_any_depth():
    deep = "<div>" * 60 + "<p>cut</p><article><h1>Title</h1><nav>menu</nav><div class=advert>ad</div><p>Own</p></article>"
    assert _texts([deep]) == ["Title Own"]
    layout = "<article>" + "<div>" * 60 + "<p>Own</p><nav>menu</nav><script>code()</script><div class=comments>c</div>"
    assert _texts([layout, layout]) == ["Own"] * 2
    unclosed = "<body>" + "<div>" * 100_000 + "<p>Own</p><aside>aside</aside>"
    assert _texts([unclosed, unclosed]) == ["Own"] * 2
    assert html_extraction.expression(html_extraction.page_wrapper(unclosed)).count("<div>") == 100_000


def test_toxicity_and_quality_learn(spark):
    rng = random.Random(1)
    good = ["stone", "river", "lamp", "cloud", "garden", "winter", "paper", "music"]
    docs, labels = [], []
    for i in range(300):
        words = [rng.choice(good) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(10, 40))]
        toxic, quality = int(i % 5 == 0), int(i % 4 != 0)
        if toxic:
            words[3] = "vileword" + rng.choice(["", "s", "ish"])
        if not quality:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words), "en", "s"))
        labels.append((i, quality, toxic))
    docs += [(400, None, "en", "s"), (401, "", "en", "s"), docs[0]]
    labels += [(None, 1, 1), (5, None, None), (999, 1, 0)]
    df, lab = frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    truth = {i: (q, t) for i, q, t in labels}
    usable = F.crc32(F.col("doc_id").cast("string")) % 4 != 0
    tox = toxicity.score(df, toxicity.train(df, lab, usable), ["doc_id"]).collect()
    qual = quality_trees.score(df, quality_trees.train(df, lab, usable), ["doc_id"]).collect()
    assert len(tox) == len(qual) == len(docs)
    for got, at in ((tox, 1), (qual, 0)):
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
        held = [r for r in got if r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 4 == 0]
        assert sum(r.predicted == truth[r.doc_id][at] for r in held) >= 0.95 * len(held)
    empty = lab.limit(0)
    assert {r.predicted for r in toxicity.score(df, toxicity.train(df, empty, usable), ["doc_id"]).collect()} <= {0, 1}
    assert quality_trees.score(frame(spark, []), quality_trees.train(df, empty, usable), ["doc_id"]).count() == 0


def test_flat_forest_walks_like_single_trees():
    rng = np.random.default_rng(0)
    x = rng.random((400, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    forest = quality_trees.grow(x, y)
    z = np.full(len(x), forest.bias)
    for root in forest.root:
        for i, row in enumerate(x[:50]):
            node = root
            while forest.left[node] != node:
                node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            z[i] += forest.value[node]
    assert np.allclose(forest.score(x[:50]), 1 / (1 + np.exp(-z[:50])))
    assert ((forest.score(x) >= 0.5) == (y > 0)).mean() > 0.97


def test_quality_rules(spark, rows):
    many = rows + [(1000 + i, t, "en", "s") for i, t in enumerate(
        ["a b c d e f g h i " * 9, "line one\nline one\n\n \nline one\nother", "# $ % & | < > *", "w" * 500])]
    got = quality_rules.judge(frame(spark, many), ["doc_id", "text"]).collect()
    assert len(got) == len(many)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        lines = Counter(x for x in (r.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
        at = defaultdict(list)
        for i in range(len(words) - 7):
            at[tuple(words[i:i + 8])].append(i)
        hit = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", r.text or "")),
                sum(lines.values()) - len(lines), len(hit))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 20 or 100 * len(hit) > 30 * len(words))
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(frame(spark, []), ["doc_id"]).count() == 0


def test_quality_references_hold_the_most_common_words(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(600)]
    many = [(i, " ".join(rng.choice(words) for _ in range(40)), f"l{i % 3}" if i % 3 else None, "s") for i in range(90)]
    many += [(100, "long " * 200_000, "l1", "s"), (101, "rare words here", "l9", "s"), (102, None, "l1", "s"), (103, " ", "l8", "s")]
    sums, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in many:
        tokens = (text or "").split()
        n[lang or ""] += bool(tokens)
        for w, k in Counter(tokens).items():
            sums[lang or ""][w] += round(quality_rules.UNIT * k / len(tokens))
    kept = []
    for parts in (1, 7):
        df = frame(spark, many).repartition(parts)
        refs = {r["lang"]: quality_rules.reference(r["ref"]) for r in quality_rules.references(df).collect()}
        assert set(refs) == {lang for lang in n if n[lang]}
        for lang, (common, hist, _) in refs.items():
            want = sorted(sorted(sums[lang], key=lambda w: (-sums[lang][w], w))[:50])
            assert [w.decode() for w in common] == want
            cells = [sums[lang][w] / n[lang] / quality_rules.UNIT for w in want]
            assert np.allclose(hist, np.array([*cells, max(0.0, 1 - sum(cells))]), atol=1e-5)
        kept.append(sorted((r.doc_id, r.char_distance, r.word_distance, r.kept) for r in quality_rules.judge(
            df, ["doc_id"], min_chars=5, min_words=2).collect() if r.doc_id < 102))
    limit, quality_rules.BROADCAST_MAX_BYTES = quality_rules.BROADCAST_MAX_BYTES, 0
    try:
        kept.append(sorted((r.doc_id, r.char_distance, r.word_distance, r.kept) for r in quality_rules.judge(
            df, ["doc_id"], min_chars=5, min_words=2).collect() if r.doc_id < 102))
    finally:
        quality_rules.BROADCAST_MAX_BYTES = limit
    assert kept[0] == kept[1] == kept[2]


def test_js_distance():
    p, q = np.array([0.5, 0.5, 0]), np.array([0, 0, 1.0])
    assert quality_rules.js_distance(p, p) == 0 and quality_rules.js_distance(p, q) == pytest.approx(1)


def test_token_rollup(spark, rows, tmp_path):
    df, root = frame(spark, rows), f"file://{tmp_path}/rollup"
    assert token_rollup.totals(spark, root).count() == 0
    names = list(token_rollup.TOKENIZERS)
    counted = token_rollup.count_tokens(df, names)
    load = token_rollup.inserts(counted)
    assert token_rollup.commit(load, root, "1") and not token_rollup.commit(load, root, "1")
    gone = token_rollup.count_tokens(df.filter("doc_id % 2 = 0"), names)
    assert token_rollup.commit(token_rollup.deletes(gone), root, "2")

    def want(keep):
        out = Counter()
        for i, t, lang, src in rows:
            if keep(i):
                for name, p in (("space-1", r"[^\x20\x09-\x0D]+"), ("alnum-1", r"[0-9A-Za-z\x80-\U0010ffff]+")):
                    out[src, lang, name, "docs"] += 1
                    out[src, lang, name, "tokens"] += len(re.findall(p, t or ""))
        return {k: v for k, v in out.items() if v}

    def got(at):
        out = {}
        for r in token_rollup.totals(spark, at).collect():
            out[r.source, r.lang, r.tokenizer, "docs"] = r.n_docs
            out[r.source, r.lang, r.tokenizer, "tokens"] = r.n_tokens
        return {k: v for k, v in out.items() if v}

    assert got(root) == want(lambda i: i is None or i % 2)
    assert token_rollup.compact(spark, root, root + "2") == ["1", "2"]
    before = got(root)
    assert got(root + "2") == before
    assert not token_rollup.commit(load, root + "2", "1") and got(root + "2") == before
    # A batch committed after the list was stored is not folded by a compaction begun anew, and not lost.
    late = token_rollup.inserts(gone)
    assert token_rollup.commit(late, root, "3") and token_rollup.compact(spark, root, root + "2") == ["1", "2"]
    assert got(root + "2") == before
    assert token_rollup.commit(late, root + "2", "3") and got(root + "2") == got(root)
    assert token_rollup.compact(spark, root + "-none", root + "3") == [] and not got(root + "3")


def test_digest_columns(spark, sf_small):
    """The thin queries return the contract's columns."""
    from tidelog.llm.queries import QUERIES

    want = {"op1_toxicity": {"doc_id", "held_out", "score", "predicted"},
            "op4_shards": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
            "op5_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
            "op6_ngram_join": {"doc_id", "n_shingles", "component_id"},
            "op7_main_text": {"page_id", "url", "text", "n_chars"}}
    for name, columns in want.items():
        assert columns <= set(QUERIES[name](spark, sf_small).columns)
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit("").cast("binary"), 256)).first()[0]


def test_ngram_join_one_id_with_several_texts_and_large_ids(spark):
    """No link is lost where an id has two texts, in either order of their hashes, and no id beside a null is rounded."""
    a, b = "alpha beta gamma delta epsilon zeta eta theta iota", "stone river cloud lamp house tree wort sky sea"
    big = 2**53 + 1
    for x, y in ((a, b), (b, a)):
        rows = [(1, x), (1, y), (2, b), (3, b + " end"), (4, "lone words here"), (None, a), (None, "x y z"), (big, "big id")]
        df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, signature string")
        got = Counter((r.doc_id, r.component_id) for r in ngram_join.similar(df, 3, 80).collect())
        assert got == Counter({(1, 1): 2, (2, 1): 1, (3, 1): 1, (4, 4): 1, (None, 1): 1, (None, None): 1, (big, big): 1})
