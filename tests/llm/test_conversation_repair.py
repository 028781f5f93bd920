"""Conversation repair against a plain search over whole edit strings."""

import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tidelog.llm import conversation_repair as cr
from tidelog.llm.common import Scratch

SCHEMA = "conv_id long, turn long, role string, text string, conv string, key string, audit int"
EMPTY = hashlib.sha256(b"").hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "k", 1) for r in rows], SCHEMA).repartition(3)


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows, faults):
    """All edit strings are grown row by row; per final role the (cost, edits, repaired) least of all is kept."""
    def insert(at):
        for _ in range(4):
            for last, (c, e, rep) in list(at.items()):
                role = "assistant" if last == "u" else "user"
                new = (c + 2, e + "I", rep + [(role, "")])
                if role[0] not in at or new[:2] < at[role[0]][:2]:
                    at[role[0]] = new
        return at

    at = {"": (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults):
        at, after = insert(at), {}
        for last, (c, e, rep) in at.items():
            options = [(3, "D", last, [])]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                for new in ("user", "assistant"):
                    options.append((2 + more, "R", new[0], [(new, text)]))
                if role[:1] in ("s", "u", "a"):
                    options.append((more, "K", role[0], [(role, text)]))
            for cost, edit, new, made in options:
                legal = edit == "D" or last + new in ("s", "u", "su", "ua", "au")
                if legal and (new not in after or (c + cost, e + edit) < after[new][:2]):
                    after[new] = (c + cost, e + edit, rep + made)
        at = after
    at = insert(at)
    return min((at[k] for k in ("", "a") if k in at), key=lambda x: x[:2])


def expected(rows):
    out, by = [], {}
    for r in damaged(rows):
        by.setdefault(r[0], []).append(r)
    for conv in {r[0] for r in rows}:
        mine = sorted(by.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        seen, faults = set(), []
        for _, _, role, text in mine:
            last = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not last else "duplicate" if (role, text) in seen
                          else "truncated" if last[-1] not in ".!?" else None)
            seen.add((role, text))
        cost, audit, made = cheapest(mine, faults)
        turns = [r[1] for r in mine if r[1] is not None]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
                    sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()))
    return sorted(out, key=repr)


def answers(spark, rows):
    df = frame(spark, rows)
    return sorted((tuple(r) for r in cr.report(df, cr.damage(df)).collect()), key=repr)


@pytest.fixture
def rows():
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Cut off here", "", " \n", None, "Why?", "Ça va. ", "x\x1c"]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    out = [(c, t, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"Text {c} {t}.")
           for c in range(150) for t in range(rng.randint(1, 9)) if rng.random() < 0.9]
    out += [(500, t, ("user", "assistant")[t % 2], f"Line {t}.") for t in range(8)]
    out += [(None, 1, "user", "Hm."), (None, None, "user", "Hm."), (None, 1, "user", "Hm."), (501, None, "user", "a."), (501, None, None, None)]
    out += [(502, 3, r, t) for r, t in (("user", "b."), ("user", "a."), ("assistant", "b."), ("user", "b."))] * 2
    return out + [(9007199254740993, 0, "user", "Big?"), (9007199254740993, 9007199254740993, "assistant", "Yes.")]


def test_against_search(spark, rows):
    assert answers(spark, rows) == expected(rows)


def test_long_conversations_span_pieces_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(cr, "PIECE", 7)
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Ok.", f"t{t}.", f"t{t}", ""])) for t in range(900)]
    rows += [(2, 5, "user", "Same.")] * 200 + [(2, 6, "assistant", "x" * 300_000 + ".")] + [(3, t, "user", f"{t}.") for t in range(40)]
    assert answers(spark, rows) == expected(rows)


def test_empty_and_lost(spark):
    assert answers(spark, []) == []
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert answers(spark, [(lost, 0, "user", "Gone.")]) == [(lost, 0, 0, 0, 0, 0, 0, "", EMPTY)]


def test_repaired_rows(spark, rows):
    df = frame(spark, rows)
    found = cr.damage(df)
    _, places, _ = cr.plan_edits(found, Scratch(spark, "t"))
    got = cr.repaired_rows(cr._keyed(found), places).orderBy("conv", "position").collect()
    digest = {conv: hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in part).encode()).hexdigest()
              for conv, part in groupby(got, lambda r: r.conv)}
    ids = {r.conv: r.conv_id for r in df.select("conv_id").distinct().withColumn("conv", F.to_json(F.struct("conv_id"))).collect()}
    want = {c[0]: c[-1] for c in expected(rows)}
    assert {ids[conv]: d for conv, d in digest.items()} == {c: d for c, d in want.items() if d != EMPTY}
    assert all("".join(r.role[0] for r in part).replace("ua", "") in ("", "s") for _, part in groupby(got, lambda r: r.conv))


def test_rules_give_the_product_of_their_parts():
    rules = [("Ā", "ua"), ("ā", "ĀĀ"), ("Ă", "Xā")]
    matrices = cr.rule_matrices(rules)
    flat = lambda m: [[e and (e[0], str(e[1])) for e in row] for row in m]
    assert flat(matrices["Ă"]) == flat(cr.product("Xuaua", cr.TERMINALS))
