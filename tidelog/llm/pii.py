"""Personal data: base patterns, and terms that give protected entities away.

Base spans are e-mail addresses, IPv4 addresses, payment cards and phone
numbers, found in whole texts with their code point offsets. Every distinct
base value is a protected entity. Every term (a word of letters outside of base
spans) of a text with an entity is judged by what the corpus says: with ``n``
distinct texts, of which ``n_c`` hold the entity, ``n_t`` the term and ``n_ct`` both,

    IC(c) - PMI(c; t) = -log2 p(c | t),  p(c | t) = n_ct / n_t

is what the term leaves open about the entity, in bits: 0 when it occurs nowhere but with
the entity, and IC(c) when they are independent. Few texts prove little, so p(c | t) is taken
at its lower confidence bound (Wilson's, one-sided, at ``Z``). A term gives the entity away
if the bound leaves at most ``OPEN`` bits open and still tells at least ``TOLD`` bits (PMI).
Such a term is removed if it was never seen without the entity and generalised if it was,
wherever it stands in a text with the entity. Only the counts of the term and the entity
decide how much is left open: a word of one or two texts is no evidence in a corpus of any
size, and there is no other minimum. Exact copies count once. All
counts cover the whole corpus. Entities that stand in the same texts have the
same disclosures and are scored as one group.

DataFrame functions only. Offsets come from the pieces between the matches, so
a text is read by each pattern twice and never per character, whatever the number
of matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import broadcast_if_small, stored

# Fixed patterns. Possessive runs and the look-behinds save retries inside a run of
# characters, where a match would have begun at the run's start (or the last match's end).
# A possessive group is matched in a loop; a greedy one recurses for each round and overflows
# the stack on a few thousand digits or labels. Nothing follows it, so the matches are the same.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"\p{L}[\p{L}\p{M}]{2,}+"
KINDS = ("email", "ip", "card", "phone")

OPEN, TOLD = 1.0, 1.0   # bits
Z = 1.645               # 95 %, one-sided
# Spans of a text that are folded together; work on a text of m spans grows with m * (GROUP + m / GROUP).
GROUP = 256
SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _groups(n: Column) -> Column:
    return F.sequence(F.lit(0), F.floor((n - 1) / GROUP).cast("int"))


def _members(group: Column, n: Column) -> Column:
    """The positions of a group's up to ``GROUP`` entries of an array of ``n``."""
    return F.sequence(group * GROUP, F.least(group * GROUP + GROUP, n) - 1)


def _before(n: Column, join: Callable[[Column, Column], Column]) -> Column:
    """What ``join`` (of a state, from 0 on, and a position) has come to before each group, and after the last."""
    return F.aggregate(_groups(n), F.array(F.lit(0)), lambda acc, g: F.concat(
        acc, F.array(F.aggregate(_members(g, n), F.element_at(acc, -1), join))))


def found(text: Column, pattern: str, maybe: Column) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as structs (start, end, value); none where not ``maybe``.

    The text is read twice; arrays only grow within ``GROUP`` matches, or by one entry for each such group.
    """
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def spans(p: Column) -> Column:
        gaps, values, n = p["gaps"], p["values"], F.size(p["values"])

        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.get(gaps, i))
            end = start + F.length(F.get(values, i))
            span = F.struct(start.alias("start"), end.alias("end"), F.get(values, i).alias("value"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        starts = _before(n, lambda at, i: at + F.length(F.get(gaps, i)) + F.length(F.get(values, i)))
        all_of = _let(starts, lambda at: F.flatten(F.transform(_groups(n), lambda g: F.aggregate(
            _members(g, n), F.struct(F.get(at, g).alias("at"), empty.alias("out")), step)["out"])))
        return F.when(n > 0, all_of).otherwise(empty)

    pieces = F.struct(F.split(text, pattern, -1).alias("gaps"),
                      F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)).alias("values"))
    return F.when(maybe, _let(pieces, spans)).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + _luhn_digit(F.substring(F.reverse(digits), i, F.lit(1)).cast("int"), i))
    return total % 10 == 0


def _luhn_digit(d: Column, i: Column) -> Column:
    return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: _part_ok(F.regexp_replace(p, "^0+", "")))
    if kind == "card":
        d = _digits(value)
        return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _part_ok(part: Column) -> Column:
    return (F.length(part) < 3) | ((F.length(part) == 3) & (part <= F.lit("255")))


def base_spans(text: Column) -> Column:
    """Valid base spans of a non-null text, by kind as listed and start."""
    out = []
    for kind, pattern, maybe in (("email", EMAIL, F.contains(text, F.lit("@"))), ("ip", IP, text.rlike("[0-9][.][0-9]")),
                                 ("card", CARD, text.rlike("[0-9][0-9 -]{14}")), ("phone", PHONE, F.contains(text, F.lit("+")))):
        out.append(F.transform(_kept(kind, found(text, pattern, maybe)), _named(kind)))
    return F.concat(*out)


def _kept(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def _named(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                              s["value"].alias("value"))


def _rewritten(text: Column, spans: Column, put: Callable[[Column, Column], Column]) -> Column:
    """The text with ``put(span, at)`` in place of each span, where ``at`` is the end of the spans before it.

    Spans (structs with start and end) come by start and may overlap; what any of them covers goes.
    Up to ``GROUP`` spans share a stretch of the text, so that no span is looked up in the whole text.
    """

    def one(s: Column) -> Column:
        n = F.size(s)
        ends = _before(n, lambda at, i: F.greatest(at, F.get(s, i)["end"]))

        def group(g: Column, at: Column) -> Column:
            first = F.get(at, g)
            stretch = F.substring(text, first + F.lit(1), F.get(at, g + 1) - first)

            def step(acc: Column, i: Column, local: Column) -> Column:
                span = F.get(s, i)
                gap = F.substring(local, acc["at"] - first + F.lit(1), F.greatest(acc["at"], span["start"]) - acc["at"])
                return F.struct(F.greatest(acc["at"], span["end"]).alias("at"),
                                F.concat(acc["out"], gap, put(span, acc["at"])).alias("out"))

            return _let(stretch, lambda local: F.aggregate(
                _members(g, n), F.struct(first.alias("at"), F.lit("").alias("out")), lambda acc, i: step(acc, i, local))["out"])

        done = _let(ends, lambda at: F.concat(F.array_join(F.transform(_groups(n), lambda g: group(g, at)), ""),
                                              F.substring(text, F.element_at(at, -1) + F.lit(1), F.length(text))))
        return F.when(n > 0, done).otherwise(text)

    return _let(spans, one)


def _blanked(text: Column, spans: Column) -> Column:
    """The text with spaces in place of the spans, at unchanged offsets."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return _rewritten(text, ordered, lambda s, at: F.repeat(
        F.lit(" "), F.greatest(at, s["end"]) - F.greatest(at, s["start"])))


def _words(text: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({TERM})"), F.lit(1))


def _terms(text: str) -> Column:
    return F.array_distinct(F.transform(_words(text), F.lower))


def term_counts(texts: DataFrame) -> tuple[int, DataFrame]:
    """The number of distinct texts, and ``term``, ``n_t``; ``texts``: __text_hash and __text of all documents.

    Each of a text's copies counts as its share of one, so no (text, term) pair is shuffled.
    """
    copies = stored(texts.groupBy("__text_hash").agg(F.count(F.lit(1)).alias("copies")), "pii_copies")
    repeated = broadcast_if_small(copies.filter(F.col("copies") > 1), F.lit(24))
    share = F.lit(1.0) / F.coalesce("copies", F.lit(1))
    counted = texts.join(repeated, "__text_hash", "left") \
        .select(share.alias("share"), F.explode(_terms("__text")).alias("term")) \
        .groupBy("term").agg(F.round(F.sum("share")).alias("n_t"))
    return copies.count(), counted


def sure_share(part: Column, whole: Column, z: float = Z) -> Column:
    """Wilson's lower bound of the share that ``part`` of ``whole`` trials show."""
    p = F.least(part / whole, F.lit(1.0))
    spread = F.lit(z) * F.sqrt(p * (1 - p) / whole + F.lit(z * z) / (4 * whole * whole))
    return (p + F.lit(z * z) / (2 * whole) - spread) / (1 + F.lit(z * z) / whole)


def disclosing(found_texts: DataFrame, texts: DataFrame, open_bits: float = OPEN, told_bits: float = TOLD,
               z: float = Z) -> DataFrame:
    """``__key``, ``term``, ``kind`` of the terms that give an entity of their text away.

    ``found_texts``: __key, base and __clean of each distinct text with an entity;
    ``texts``: __text_hash and __text of all documents.
    """
    n, n_t = term_counts(texts)
    holds = found_texts.select("__key", F.explode(F.array_distinct(F.transform("base", lambda s: s["value"]))).alias("entity"))
    # Which texts an entity stands in, as a number of fixed size.
    same = [F.bit_xor(F.xxhash64("__key", F.lit(i))).alias(f"same_{i}") for i in (1, 2)]
    groups = stored(holds.groupBy("entity").agg(F.count(F.lit(1)).cast("double").alias("n_c"), *same), "pii_entities")
    group = ["n_c", "same_1", "same_2"]
    members = holds.join(broadcast_if_small(groups, F.octet_length("entity") + F.lit(48)), "entity") \
        .select("__key", *group).distinct()
    # As n_ct <= n_c and the bound is at most n_ct / n_t, a term of more texts leaves more open.
    times = 2.0 ** open_bits * 1.000001
    largest = groups.agg(F.max("n_c")).first()[0] or 0.0
    pairs = stored(found_texts.select("__key", F.explode(_terms("__clean")).alias("term"))
                   .join(n_t.filter(F.col("n_t") <= times * largest), "term")
                   .join(members, "__key").filter(F.col("n_t") <= times * F.col("n_c")), "pii_pairs")
    share = sure_share(F.col("n_ct"), F.col("n_t"), z)
    told = pairs.groupBy("term", "n_t", *group).agg(F.count(F.lit(1)).alias("n_ct")) \
        .filter((share >= 2.0 ** -open_bits) & (share * n >= F.lit(2.0 ** told_bits) * F.col("n_c"))) \
        .select("term", *group, (F.col("n_ct") >= F.col("n_t")).alias("only"))
    kind = F.when(F.max("only"), "revealing").otherwise("term")
    return pairs.join(told, ["term", *group]).groupBy("__key", "term").agg(kind.alias("kind"))


def places(found_texts: DataFrame) -> DataFrame:
    """``__key``, ``term``, ``start``, ``end`` of every word of letters in ``__clean`` (one row per __key)."""
    parts = F.arrays_zip(F.split("__clean", TERM, -1).alias("gap"), _words("__clean").alias("word"))
    lengths = F.transform(parts, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["word"]).alias("size"),
                                                    F.lower(x["word"]).alias("term")))
    so_far = Window.partitionBy("__key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("x.gap") + F.col("x.size")).over(so_far).cast("int")
    return found_texts.select("__key", F.posexplode(lengths).alias("pos", "x")).filter(F.col("x.term").isNotNull()) \
        .select("__key", "x.term", "x.size", end.alias("end")) \
        .select("__key", "term", (F.col("end") - F.col("size")).alias("start"), "end")


def find(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``base`` (array of kind, start, end, value) and ``terms``
    (array of kind, start, end, value: the term, kind ``term`` or ``revealing``).

    Kind ``revealing`` is a term to remove, ``term`` one to generalise. Null and empty
    texts have no spans; repeated rows each have theirs; a null id is an id like
    any other; an empty table gives an empty result. Spans of different kinds may
    overlap. Offsets are code points, the end is exclusive.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    spans = docs.select(*keep, text.alias("__text")).withColumn("__key", F.md5(F.col("__text").cast("binary"))) \
        .withColumn("base", base_spans(F.col("__text"))) \
        .withColumn("__clean", F.when(F.size("base") > 0, _blanked(F.col("__text"), F.col("base")))) \
        .drop("__text")
    spans = stored(spans, "pii_base")
    texts = docs.select(F.xxhash64(text).alias("__text_hash"), text.alias("__text"))
    found_texts = stored(spans.filter(F.size("base") > 0).select("__key", "base", "__clean").dropDuplicates(["__key"]),
                         "pii_found")
    told = stored(disclosing(found_texts, texts), "pii_told")
    per_doc = places(found_texts.join(told.select("__key").distinct(), "__key", "left_semi")).join(told, ["__key", "term"]) \
        .groupBy("__key").agg(F.sort_array(F.collect_list(F.struct(
            "start", "end", "kind", F.col("term").alias("value")))).alias("terms"))
    per_doc = broadcast_if_small(stored(per_doc, "pii_doc_terms"), F.size("terms") * 48 + F.lit(64))
    out = spans.drop("__clean").join(per_doc, "__key", "left").drop("__key")
    ordered = F.transform("terms", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                      s["end"].alias("end"), s["value"].alias("value")))
    return out.withColumn("terms", F.coalesce(ordered, F.array().cast(f"array<{SPAN}>")))


def as_text(spans: Column, kind: Column | None = None) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", kind if kind is not None else s["kind"], s["start"], s["end"])), ",")


def sanitise(found_rows: DataFrame, text_col: str = "text") -> DataFrame:
    """``find``'s rows (kept with their text) with base spans and generalised terms as
    their kind in brackets and revealing terms gone. Of overlapping spans the first
    names the place, and all that they cover goes."""
    text = F.col(text_col).cast("string")
    spans = F.array_sort(F.transform(F.concat("base", "terms"), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def put(s: Column, at: Column) -> Column:
        tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when((s["start"] < at) | (s["kind"] == "revealing"), F.lit("")).otherwise(tag)

    done = _rewritten(text, spans, put)
    changed = F.size("base") + F.size("terms") > 0
    return found_rows.withColumn(text_col, F.when(changed, done).otherwise(F.col(text_col))).drop("base", "terms")
