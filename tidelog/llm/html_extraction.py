"""HTML extraction by union-free regular-expression inference.

The pages of a host are aligned into one wrapper: a regular expression without
unions over element tokens and text slots. A page's token stream is folded into
the wrapper level by level. Along the children of an element

* a child seen on all pages so far stays required, one that is missing on some
  page becomes optional;
* a child that repeats becomes a repeated group of itself; children that appear
  in both orders become one repeated group of optional members;
* text becomes a slot. Its constants are the blocks of text that every page with
  the slot has in it (one for plain template text, some members of a repeated
  group); what differs makes it a field.

Folding two wrappers is the same alignment, and the result does not depend on
the order: each task folds the pages it reads, then the wrappers of a host are
folded in a second step (equal ones once), in parts where a host has many.

The slots of the article are chosen on the wrapper: those inside the article
(else main, else the best named container, else the body) and outside of menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments; names of classes and ids are a hint there, which drops no body,
article or main. Inside an article an optional or repeated element outside of the
text's flow (no paragraph, heading, list item or the like) goes as well where its
text is the same on all its pages, at least two different ones; where nothing marks
the article, any such element but headings and what stands in the flow beside text
that differs. If no chosen slot differs, nothing goes. Every page is then parsed
along its host's wrapper and the texts in the chosen slots are its main text,
block by block. Nothing recurses, so elements may nest to any depth.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import BROADCAST_MAX_BYTES, Kept, small_batches, stored

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
# A start tag of the first kind ends an open element of the second.
BLOCKS = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 "
                   "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
        "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = frozenset("ul ol dl table div section article td th body".split())

# Elements, roles and names (of classes and ids) that are not article text.
NOT_TEXT = frozenset("head script style noscript template iframe object svg canvas nav header footer aside form button "
                     "select textarea dialog menu".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
NOT_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies dialog disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pagination pager popup promo promoted promotion related reply replies responses search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget".split())
MAIN_NAMES = ("article", "content", "main", "post", "entry", "story", "body", "text")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Elements that names of classes and ids never drop.
CONTAINERS = frozenset("html body article main".split())
# Elements of a text's own flow: a constant in them is a byline, a heading or a label of the article.
FLOW = HEADINGS | CONTAINERS | frozenset("p li blockquote pre dt dd td th caption figcaption".split())
# Different pages (copies count once) that a slot's constants need: the fewest that can be aligned.
SEVERAL = 2
# Wrappers of a host that are folded in one group of the second step.
FOLD = 64

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S)
_ATTR = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def _key(tag: str, attrs: str) -> str:
    """An element's token: tag and, if it has them, words of class, id and role."""
    if not attrs or "=" not in attrs:
        return tag
    found = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
    names = sorted(set(_NAME.findall(f"{found.get('class', '')} {found.get('id', '')}".lower())))
    role = _NAME.findall(found.get("role", "").lower())[:1]
    hidden = ["hidden"] if "hidden" in found else []
    parts = ["." + ".".join(names)] if names else []
    return tag + "".join(parts + ["@" + r for r in role + hidden])


def events(page: str) -> Iterator[tuple[str, str]]:
    """('open', key), ('close', key), ('text', decoded text), ('cut', tag) of the blocks of a page.

    Inline elements only part text where they are marked as not text; ``br`` parts words.
    """
    stack: list[str] = []
    tags: list[str] = []
    opened: dict[str, int] = {}

    def close(depth: int):
        while len(stack) > depth:
            opened[tags.pop()] -= 1
            yield "close", stack.pop()

    pos, size = 0, len(page)
    while pos < size:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        tag = m.group(2)
        if tag is None:
            token = m.group()
            if token[0] != "<" or token == "<":
                yield "text", entities.unescape(token) if "&" in token else token
            elif token.startswith("<![CDATA["):
                yield "text", token[9:].removesuffix("]]>")
            continue
        tag = tag.lower()
        if m.group(1):
            if opened.get(tag):
                at = len(tags) - 1
                while tags[at] != tag:
                    at -= 1
                yield from close(at)
            elif tag in ("br", "p"):
                yield "text", " "
            continue
        if tag in VOID:
            if tag not in INLINE:
                yield "text", " "
            continue
        key = _key(tag, m.group(3))
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, pos)
            raw = page[pos:end.start() if end else size]
            pos = end.end() if end else size
            if tag == "noscript":
                continue
            yield "open", key
            yield "text", raw
            yield "close", key
            continue
        if tag in INLINE and _bare(key):
            continue
        if tag in BLOCKS and opened.get("p"):
            at = len(tags) - 1
            while tags[at] != "p" and tags[at] not in SCOPES:
                at -= 1
            if tags[at] == "p":
                yield from close(at)
        ends = ENDS.get(tag)
        if ends:
            for at in range(len(tags) - 1, -1, -1):
                if tags[at] in ends:
                    yield from close(at)
                    break
                if tags[at] in SCOPES and not (tag in ("tr", "tbody", "tfoot") and tags[at] in ("td", "th")):
                    break
        stack.append(key)
        tags.append(tag)
        opened[tag] = opened.get(tag, 0) + 1
        yield "open", key
    yield from close(0)


def _names(key: str) -> tuple[str, set[str], str]:
    head, _, role = key.partition("@")
    tag, *names = head.split(".")
    return tag, set(names), role


_BARE: dict[str, bool] = {}


def _bare(key: str) -> bool:
    """Whether an inline element is plain text markup."""
    if key not in _BARE:
        if len(_BARE) > 100_000:
            _BARE.clear()
        _BARE[key] = not _not_text(key)
    return _BARE[key]


def _not_text(key: str) -> bool:
    return _never_text(key) or _hinted(key)


def _never_text(key: str) -> bool:
    """Whether tag or role say that an element is not article text."""
    tag, _, role = _names(key)
    if tag in ("html", "body"):
        return False
    return tag in NOT_TEXT or bool(set(role.split("@")) & (NOT_TEXT_ROLES | {"hidden"}))


def _hinted(key: str) -> bool:
    """Whether names of class and id hint that an element is not article text."""
    tag, names, _ = _names(key)
    return tag not in CONTAINERS and bool(names & NOT_TEXT_NAMES)


NEVER, DOUBTED, TEXT = range(3)


def _shown(key: str, parent: int) -> int:
    """Whether an element's text is article text; an article or main ends the doubts that names raise."""
    if parent == NEVER or _never_text(key):
        return NEVER
    if _names(key)[0] in CONTAINERS:
        return TEXT
    return DOUBTED if parent == DOUBTED or _hinted(key) else TEXT


# A wrapper node: {"n": pages or parents with it, "r": repeats, "c": {key: node}, "o": {(before, after)},
# "k": hashes of the blocks of text that every page with text in it has (None: no text), "v": whether pages
# differ in their blocks, "t": the least SEVERAL hashes of the pages with text in it}


def _node() -> dict:
    return {"n": 0, "r": 0, "c": {}, "o": set(), "k": None, "v": 0, "t": []}


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")


def _block(words: list[str]) -> str:
    return _SPACE.sub(" ", "".join(words)).strip()


def page_wrapper(page: str) -> dict:
    """The wrapper of a single page. Pages whose texts outside of menus and the like are equal are the same page."""
    root = _node()
    root["n"] = 1
    # (node, keys of the children in order of their last appearance, whether its text is article text)
    path = [(root, {}, TEXT)]
    words: list[str] = []
    slots: list[dict] = []
    own = hashlib.blake2b(digest_size=7)

    def end_block():
        text = _block(words) if words else ""
        words.clear()
        if text:
            node, _, shown = path[-1]
            if node["k"] is None:
                node["k"] = set()
                slots.append(node)
            node["k"].add(_hash(text))
            if shown == TEXT:
                own.update(text.encode("utf-8", "surrogatepass") + b"\0")

    for kind, value in events(page):
        if kind == "text":
            words.append(value)
            continue
        end_block()
        node, order, shown = path[-1]
        if kind == "open":
            child = node["c"].setdefault(value, _node())
            last = next(reversed(order), value)
            if last != value:
                node["o"].add((last, value))
            if order.pop(value, None):
                child["r"] = 1
            order[value] = child
            path.append((child, {}, _shown(value, shown)))
        else:
            path.pop()
            _leave(order)
    end_block()
    _leave(path[0][1])
    seen = [int.from_bytes(own.digest(), "big")]
    root["t"] = seen
    for node in slots:
        node["t"] = seen
    return root


def _leave(order: dict) -> None:
    """Count each kind of child of an element that ends once."""
    for child in order.values():
        child["n"] += 1


def align(a: dict, b: dict) -> dict:
    """The wrapper of what ``a`` and ``b`` wrap; into ``a``."""
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        x["n"] += y["n"]
        x["r"] = max(x["r"], y["r"])
        x["t"] = sorted({*x["t"], *y["t"]})[:SEVERAL]
        x["v"] |= y["v"]
        if x["k"] is None:
            x["k"] = y["k"]
        elif y["k"] is not None:
            x["v"] |= int(x["k"] != y["k"])
            x["k"] = x["k"] & y["k"]
        x["o"] |= y["o"]
        for key, child in y["c"].items():
            if key in x["c"]:
                todo.append((x["c"][key], child))
            else:
                x["c"][key] = child
    return a


def dump(node: dict) -> str:
    """A wrapper as text, one entry per element with its depth; equal wrappers have equal texts."""
    out, todo = [], [(0, "", node)]
    while todo:
        depth, key, x = todo.pop()
        constants = None if x["k"] is None else sorted(x["k"])
        out.append([depth, key, x["n"], x["r"], x["t"], constants, x["v"], sorted(map(list, x["o"]))])
        todo += [(depth + 1, k, x["c"][k]) for k in sorted(x["c"], reverse=True)]
    return json.dumps(out, ensure_ascii=False, separators=(",", ":"))


def load(text: str) -> dict:
    path: list[dict] = []
    for depth, key, n, r, t, k, v, o in json.loads(text):
        node = {"n": n, "r": r, "t": t, "k": None if k is None else set(k), "v": v, "o": set(map(tuple, o)), "c": {}}
        del path[depth:]
        if path:
            path[-1]["c"][key] = node
        path.append(node)
    return path[0]


def expression(node: dict) -> str:
    """The wrapper as a readable union-free expression: ``#`` fields, ``=`` constant slots, ``?`` optional,
    ``+`` repeated, ``( )`` groups."""
    out: list[str] = []
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += reversed(_parts(x))
    return "".join(out)


def _parts(node: dict) -> list:
    """What an element holds: pieces of the expression, and child nodes still to be written."""
    reach = {k: {k} for k in node["c"]}
    changed = True
    while changed:
        changed = False
        for a, b in node["o"]:
            more = reach[b] - reach[a]
            if more:
                reach[a] |= more
                changed = True
    parts, done = [], set()
    for key in sorted(node["c"], key=lambda k: (-len(reach[k]), k)):
        if key in done:
            continue
        group = sorted(k for k in reach[key] if key in reach[k])
        done.update(group)
        if len(group) > 1:
            inner = [[*_item(k, node["c"][k]), "?"] for k in group]
            parts.append(["(", *_joined(inner), ")+"])
        else:
            child = node["c"][key]
            mark = ("+" if child["r"] else "") + ("?" if child["n"] < max(node["n"], 1) else "")
            parts.append([*_item(key, child), mark])
    slot = [["#" if node["v"] or len(node["k"]) != 1 else "="]] if node["k"] is not None else []
    return _joined(slot + parts)


def _joined(items: list[list]) -> list:
    return [x for i, item in enumerate(items) for x in ([" ", *item] if i else item)]


def _item(key: str, node: dict) -> list:
    return [f"<{key}>", node, "</>"] if node["c"] or node["k"] is not None else [f"<{key}/>"]


def chosen(wrapper: dict) -> dict:
    """The tree of the wrapper's elements with, for each, whether its slot is article text
    ("keep") and the hashes of the blocks in it that are the host's ("drop")."""
    parents: dict[int, int] = {}

    def find(test, trusting):
        """The outermost elements that pass; below a hint only if not ``trusting`` hints, and then such that do not repeat."""
        found, todo = [], [(wrapper, False)]
        while todo:
            node, doubt = todo.pop()
            for key, child in node["c"].items():
                parents[id(child)] = id(node)
                if _never_text(key):
                    continue
                if test(key) and not (doubt and child["r"]):
                    found.append(id(child))
                elif not _hinted(key):
                    todo.append((child, doubt))
                elif not trusting:
                    todo.append((child, True))
        return found

    def named(name):
        return lambda k: name in _names(k)[1] and _names(k)[0] in ("div", "section", "td") and not _hinted(k)

    tests = [(lambda k: _names(k)[0] == "article", False),
             (lambda k: _names(k)[0] == "main" or _names(k)[2] == "main" and not _hinted(k), False),
             (lambda k: _names(k)[2] == "article" and not _hinted(k), True)]
    tests += [(named(n), True) for n in MAIN_NAMES]
    roots: set[int] = set()
    for test, trusting in tests:
        roots = set(find(test, trusting))
        if roots:
            break
    semantic = bool(roots)
    holders: set[int] = set()
    for at in roots:
        while at in parents and parents[at] not in holders:
            at = parents[at]
            holders.add(at)

    out = {"keep": not semantic, "drop": frozenset(), "c": {}}
    slots, varies, todo = [], False, [(wrapper, out, not semantic)]
    while todo:
        node, role, inside = todo.pop()
        varies |= role["keep"] and bool(node["v"])
        beside = node["v"] or any(c["v"] for c in node["c"].values())
        for key, child in node["c"].items():
            if child["k"] is not None and not child["v"] and len(child["t"]) >= SEVERAL:
                slots.append((child, role["c"], key, _template(key, child, node, semantic, beside)))
            tag = _names(key)[0]
            own = role["c"][key] = {"keep": False, "drop": frozenset(), "c": {}}
            if tag == "header" and inside and HEADINGS & {_names(k)[0] for k in child["c"]} and semantic:
                # An article's own heading: its title stays, the rest of the header goes.
                for k, c in child["c"].items():
                    if _names(k)[0] in HEADINGS:
                        own["c"][k] = {"keep": True, "drop": frozenset(), "c": {}}
                        todo.append((c, own["c"][k], True))
            elif id(child) in holders or not _not_text(key) or id(child) in roots:
                own["keep"] = inside or id(child) in roots
                todo.append((child, own, own["keep"]))
    # The host's own text is what stays the same while other text differs; copies of one page say nothing.
    if varies:
        for node, roles, key, template in slots:
            if template and key in roles:
                roles[key]["drop"] = frozenset(node["k"])
    return out


def _template(key: str, child: dict, parent: dict, semantic: bool, beside: bool) -> bool:
    """Whether an element whose text is the same on all its pages is the host's and not the article's.

    In an article (or what else holds the text) that is an optional or repeated element outside of the
    text's flow. Where nothing marks the article, it is any element but headings, in the flow only
    where nothing beside it differs between pages.
    """
    tag = _names(key)[0]
    if semantic:
        return tag not in FLOW and bool(child["r"] or child["n"] < parent["n"])
    return tag not in HEADINGS and not (tag in FLOW and beside)


def extract(page: str, roles: dict) -> str:
    """The texts in the chosen slots of a page, white space inside a block as one
    space, blocks joined by one space in page order."""
    blocks: list[str] = []
    words: list[str] = []
    nothing = {"keep": False, "drop": frozenset(), "c": {}}
    path = [roles]

    def end_block():
        text = _block(words) if words else ""
        drop = path[-1]["drop"]
        if text and not (drop and _hash(text) in drop):
            blocks.append(text)
        words.clear()

    for kind, value in events(page):
        if kind == "text":
            if path[-1]["keep"]:
                words.append(value)
        elif kind == "open":
            end_block()
            path.append(path[-1]["c"].get(value, nothing))
        else:
            end_block()
            path.pop()
    end_block()
    return " ".join(blocks)


def host_of(url_col: str):
    """The host of a url, without user and port; empty where there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(F.col(url_col).cast("string"), F.lit(""))),
                            r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return host


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host`` and ``wrapper`` (text) over all pages of each host."""

    def fold_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, dict] = {}
        for batch in batches:
            for host, page in zip(batch["host"], batch["html"]):
                own = page_wrapper(page)
                held[host] = align(held[host], own) if host in held else own
            if len(held) > 20_000:
                yield pd.DataFrame([(h, dump(w)) for h, w in held.items()], columns=["host", "wrapper"])
                held = {}
        yield pd.DataFrame([(h, dump(w)) for h, w in held.items()], columns=["host", "wrapper"])

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        out = None
        for text in rows["wrapper"]:
            own = load(text)
            out = own if out is None else align(out, own)
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [dump(out)]})

    schema = "host string, wrapper string"
    parts = stored(pages.select(host_of(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
                   .filter(F.length("html") > 0).mapInPandas(fold_pages, schema), "page_wrappers")
    # Each round folds up to FOLD wrappers of a host together, until every host has one.
    while True:
        most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return parts
        groups = max(1, -(-most // FOLD))
        part = F.pmod(F.xxhash64("wrapper"), F.lit(groups))
        parts = stored(parts.groupBy("host", part.alias("part")).applyInPandas(fold, schema), "host_wrappers")
        if groups == 1:
            return parts


def main_text(pages: DataFrame, keep: list[str], url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``keep`` columns plus ``text`` and ``n_chars`` (code points).

    A null or empty page has the empty text. Pages without a host (null or odd
    urls) share one wrapper. Repeated rows are extracted each; an empty table
    gives an empty result; columns not named are not read. Host wrappers are
    broadcast when their measured size allows it; beyond that pages and wrappers
    are joined by host in pieces, so no host goes to one task.
    """
    spark = pages.sparkSession
    small_batches(spark)
    by_host = wrappers(pages, url_col, html_col)
    size = by_host.agg(F.sum(F.octet_length("wrapper")).alias("b")).first()["b"] or 0
    kept = Kept(pages, keep)
    rows = pages.select(*kept.sent, host_of(url_col).alias("__host"), F.col(html_col).cast("string").alias("__html"))
    shared = None
    if size <= BROADCAST_MAX_BYTES:
        shared = spark.sparkContext.broadcast({r["host"]: r["wrapper"] for r in by_host.collect()})
        rows = rows.withColumn("__wrapper", F.lit(None).cast("string"))
    else:
        pieces = 64
        spread = by_host.withColumn("__piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))) \
            .withColumnsRenamed({"host": "__host", "wrapper": "__wrapper"})
        rows = rows.withColumn("__piece", F.pmod(F.xxhash64("__html"), F.lit(pieces)).cast("int")) \
            .join(spread, ["__host", "__piece"], "left").drop("__piece")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for host, page, own in zip(batch.pop("__host"), batch.pop("__html"), batch.pop("__wrapper")):
                if not page:
                    texts.append("")
                    continue
                if host not in known:
                    if len(known) > 5_000:
                        known.clear()
                    known[host] = chosen(load(shared.value[host] if shared else own))
                texts.append(extract(page, known[host]))
            batch["__text"] = texts
            yield batch

    return kept.back(rows.mapInPandas(run, kept.schema("__text string"))).withColumnRenamed("__text", "text") \
        .withColumn("n_chars", F.length("text").cast("bigint"))
