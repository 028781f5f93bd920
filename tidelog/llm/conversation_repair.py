"""Repair of conversation structure: cheapest edits by min-plus products over a shared grammar.

A conversation's rows, by turn, become a sequence of symbols: role initial and
fault. Edits turn it into ``(s?(ua)+)?``; the cheapest are found over four states
(start, after s, after u, after a). Every symbol has a min-plus transfer matrix from
state to state whose entries are a cost and a rope of edit initials; sequences
multiply. Among equal costs the ASCII-least rope wins; of two ropes of one segment,
state pair and cost, neither is a prefix of the other (the longer would hold more
insertions and cost more), so the order survives concatenation and products may be
taken in any grouping.

1. Faults are found on narrow rows (hashes in place of texts).
2. Rows are range-partitioned by (conversation, turn, role, text hash), so a huge
   conversation is spread over tasks, and cut into pieces of ``PIECE`` symbols.
3. Re-Pair: pairs of adjacent symbols that are frequent over the distinct pieces of
   the corpus become rules, a bounded number of them. Every rule's matrix is
   multiplied once, bottom-up, and serves all conversations.
4. Each distinct compressed piece is multiplied out once; a conversation's pieces are
   folded in order into a vector, streamed.
5. The chosen edits meet the rows as a sorted stream of edits and rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch, small_batches, stored

PIECE = 256              # symbols of one piece
ROUNDS = 8               # rounds of Re-Pair
RULES_A_ROUND = 4
FIRST_RULE = 256         # code point of the first rule's symbol
START, SYSTEM, USER, ASSISTANT = range(4)
# Costs and final states, fixed values of the contract.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
WHITE = r"\x20\x09-\x0D"


class Rope(NamedTuple):
    """A string as a tree of concatenations: rules share their parts."""
    left: Rope | str
    right: Rope | str

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            part = todo.pop()
            if isinstance(part, str):
                out.append(part)
            else:
                todo += (part.right, part.left)
        return "".join(out)


Entry = tuple[int, "Rope | str"]
Matrix = list[list["Entry | None"]]


def better(x: Entry | None, y: Entry | None) -> Entry | None:
    """The cheaper entry; of equal costs the one with the ASCII-least edits."""
    if x is None or y is None:
        return x or y
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return x if str(x[1]) <= str(y[1]) else y


def row_times(row: list[Entry | None], m: Matrix) -> list[Entry | None]:
    """A vector of entries by state, after one more matrix."""
    out: list[Entry | None] = [None] * 4
    for i, entry in enumerate(row):
        if entry is not None:
            for j, step in enumerate(m[i]):
                if step is not None:
                    rope = entry[1] if step[1] == "" else step[1] if entry[1] == "" else Rope(entry[1], step[1])
                    out[j] = better(out[j], (entry[0] + step[0], rope))
    return out


def times(x: Matrix, y: Matrix) -> Matrix:
    return [row_times(row, y) for row in x]


def _step(moves: dict[tuple[int, int], Entry]) -> Matrix:
    return [[moves.get((i, j)) for j in range(4)] for i in range(4)]


IDENTITY = _step({(i, i): (0, "") for i in range(4)})
_TO_USER, _TO_ASSISTANT = [(i, USER) for i in (START, SYSTEM, ASSISTANT)], [(USER, ASSISTANT)]
_ONE_INSERT = _step({m: (INSERT, "I") for m in _TO_USER + _TO_ASSISTANT})
_TWO = times(_ONE_INSERT, _ONE_INSERT)
# Three insertions return to a state that fewer reach.
INSERTS: Matrix = [[better(better(IDENTITY[i][j], _ONE_INSERT[i][j]), _TWO[i][j]) for j in range(4)] for i in range(4)]


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions, then one edit of a row. ``X`` must go; else the role's initial (s, u, a; o: any
    other), upper case where the row is truncated."""
    moves: dict[tuple[int, int], Entry] = {(i, i): (DELETE, "D") for i in range(4)}
    if symbol != "X":
        more = TRUNCATED if symbol.isupper() else 0
        kept = {"s": [(START, SYSTEM)], "u": _TO_USER, "a": _TO_ASSISTANT, "o": []}[symbol.lower()]
        for m in _TO_USER + _TO_ASSISTANT:
            moves[m] = (REROLE + more, "R")
        for m in kept:
            moves[m] = (more, "K")
    return times(INSERTS, _step(moves))


TERMINALS = {c: symbol_matrix(c) for c in "XsSuUaAoO"}


def rule_matrices(rules: list[tuple[str, str]]) -> dict[str, Matrix]:
    """Matrices of the terminals and, bottom-up, of every rule (its symbol, the pair it stands for)."""
    out = dict(TERMINALS)
    for symbol, pair in rules:
        out[symbol] = times(out[pair[0]], out[pair[1]])
    return out


def product(sequence: str, matrices: dict[str, Matrix]) -> Matrix:
    """The matrix of a sequence, neighbours first, so that ropes stay shallow."""
    row = [matrices[c] for c in sequence] or [IDENTITY]
    while len(row) > 1:
        row = [times(row[k], row[k + 1]) if k + 1 < len(row) else row[k] for k in range(0, len(row), 2)]
    return row[0]


def re_pair(pieces: DataFrame, work: Scratch) -> tuple[list[tuple[str, str]], DataFrame]:
    """The rules, and ``seq`` with its ``compressed`` form: in every round the most frequent pairs
    (each sequence counts once) that share no symbol with each other become rules."""
    table = work.stored(pieces.select("seq").distinct().withColumn("compressed", F.col("seq")), "sequences")
    rules: list[tuple[str, str]] = []
    for _ in range(ROUNDS):
        at = F.sequence(F.lit(1), F.length("compressed") - 1)
        pairs = table.filter(F.length("compressed") > 1) \
            .select(F.explode(F.transform(at, lambda k: F.substr("compressed", k, F.lit(2)))).alias("pair"))
        top = pairs.groupBy("pair").count().filter("count > 1").orderBy(F.desc("count"), "pair") \
            .limit(RULES_A_ROUND * RULES_A_ROUND).collect()
        taken, form = "", F.col("compressed")
        for r in top:
            if len(taken) < 2 * RULES_A_ROUND and not set(r.pair) & set(taken):
                symbol = chr(FIRST_RULE + len(rules))
                rules.append((symbol, r.pair))
                taken += r.pair
                form = F.replace(form, F.lit(r.pair), F.lit(symbol))
        if not taken:
            break
        table = work.stored(table.withColumn("compressed", form), "sequences")
    return rules, table


def _matrices(table: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``seq`` and its matrix as 16 costs (null: no way) and 16 edit strings."""
    matrices = rule_matrices(rules)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for seq, compressed in zip(batch["seq"], batch["compressed"]):
                cells = [e for row in product(compressed, matrices) for e in row]
                out.append((seq, [None if e is None else e[0] for e in cells], ["" if e is None else str(e[1]) for e in cells]))
            yield pd.DataFrame(out, columns=["seq", "costs", "edits"])

    return table.mapInPandas(run, "seq string, costs array<bigint>, edits array<string>")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` (columns conv_id, turn, role, text; others are dropped) after the
    damage that crc32 of ``conv_id:turn`` modulo 20 decides; nulls read as one space."""
    rows = conversations.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"),
                                (F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times_ = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return rows.withColumn("text", text).withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))) \
        .withColumn("n", F.explode(F.array_repeat(F.lit(1), times_))).drop("kind", "n")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the order inside a conversation: turn (nulls first), role, then the text's hash."""
    return rows.withColumn("conv", F.to_json(F.struct("conv_id"))).withColumn("has_turn", F.col("turn").isNotNull()) \
        .withColumn("key", F.md5(F.col("text").cast("binary")))


ORDER = ["conv", "has_turn", "turn", "role", "key"]


def _symbols(rows: DataFrame) -> DataFrame:
    """Per distinct (conversation, turn, role, text): ``fault`` of its first copy, ``symbol`` of that, and copies."""
    last = F.regexp_extract("text", f"([^{WHITE}])[{WHITE}]*\\z", 1)
    narrow = rows.select("conv_id", *ORDER, (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open")) \
        .groupBy("conv_id", *ORDER).agg(F.first("blank").alias("blank"), F.first("open").alias("open"),
                                        F.count(F.lit(1)).alias("copies"))
    first = narrow.groupBy("conv", "role", "key").agg(F.min(F.struct("has_turn", "turn")).alias("first"))
    initial = F.substr("role", F.lit(1), F.lit(1))
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    fault = F.when(F.col("blank"), "blank").when(F.struct("has_turn", "turn") != F.col("first"), "duplicate") \
        .when(F.col("open"), "truncated")
    return narrow.join(first, ["conv", "role", "key"]).withColumn("initial", initial).withColumn("fault", fault) \
        .withColumn("symbol", F.when(F.col("fault").isin("blank", "duplicate"), "X")
                    .when(F.col("fault") == "truncated", F.upper(role)).otherwise(role)) \
        .select("conv_id", *ORDER, "initial", "fault", "symbol", "copies")


def _pieces(symbols: DataFrame) -> DataFrame:
    """Pieces of at most ``PIECE`` symbols: place of the first symbol (``ORDER``, task and number),
    ``seq``, and ``illegal``, the illegal neighbours inside; ``head`` and ``tail`` are its end initials."""
    from pyspark import TaskContext

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number = TaskContext.get().partitionId(), 0
        conv, where, held, illegal, head, tail = None, None, [], 0, "", ""

        def piece():
            return (*where, task, number, "".join(held), illegal, head, tail)

        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                left = row.copies
                while left:
                    if held and (row.conv != conv or len(held) == PIECE):
                        out.append(piece())
                        number, held, illegal = number + 1, [], 0
                    # Copies beyond the first are duplicates (or blank): they must go, too.
                    first = left == row.copies
                    run_ = 1 if first else min(left, PIECE - len(held))
                    if held:
                        illegal += tail + row.initial not in ("su", "ua", "au")
                    else:
                        conv, head = row.conv, row.initial
                        where = (row.conv, row.has_turn, row.turn, row.role, row.key)
                    illegal += run_ - 1
                    held += [row.symbol if first else "X"] * run_
                    tail, left = row.initial, left - run_
            yield pd.DataFrame(out, columns=NAMES)
        if held:
            yield pd.DataFrame([piece()], columns=NAMES)

    NAMES = [*ORDER, "task", "number", "seq", "illegal", "head", "tail"]
    parts = symbols.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER) \
        .select("conv", "has_turn", F.col("turn").cast("string").alias("turn"), "role", "key", "initial", "symbol", "copies")
    return parts.mapInPandas(run, "conv string, has_turn boolean, turn string, role string, key string, task int, number long, "
                                  "seq string, illegal long, head string, tail string")


def _chosen(pieces: DataFrame) -> DataFrame:
    """Per conversation (sorted stream of its pieces): one row per piece with its share of the edits,
    and one (``number`` null) with the cost and the illegal neighbours of the whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, vector, illegal, tail, seen = None, None, 0, "", []

        def close():
            done = row_times(vector, INSERTS)
            end = better(done[START], done[ASSISTANT])
            audit, at = str(end[1]), 0
            for k, (task, number, n) in enumerate(seen):
                start, rows = at, 0
                while rows < n or (k == len(seen) - 1 and at < len(audit)):
                    rows += audit[at] != "I"
                    at += 1
                yield (conv, task, number, audit[start:at], None, None)
            yield (conv, None, None, audit, end[0], illegal)

        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.conv != conv:
                    if conv is not None:
                        out += close()
                    conv, vector, illegal, tail, seen = row.conv, [(0, ""), None, None, None], 0, "", []
                cells = [None if pd.isna(c) else (int(c), e) for c, e in zip(row.costs, row.edits)]
                vector = row_times(vector, [cells[k:k + 4] for k in range(0, 16, 4)])
                illegal += row.illegal + (bool(seen) and tail + row.head not in ("su", "ua", "au"))
                tail = row.tail
                seen.append((row.task, row.number, len(row.seq)))
            yield pd.DataFrame(out, columns=NAMES).astype({"cost": "Int64", "illegal": "Int64", "task": "Int64", "number": "Int64"})
        if conv is not None:
            yield pd.DataFrame(list(close()), columns=NAMES).astype({"cost": "Int64", "illegal": "Int64", "task": "Int64", "number": "Int64"})

    NAMES = ["conv", "task", "number", "audit", "cost", "illegal"]
    return pieces.repartition("conv").sortWithinPartitions("conv", "task", "number") \
        .select("conv", "task", "number", "seq", "illegal", "head", "tail", "costs", "edits") \
        .mapInPandas(run, "conv string, task int, number long, audit string, cost long, illegal long")


def _edited(stream: Iterator[tuple]) -> Iterator[tuple[str, list[tuple[str, str]], bool]]:
    """(conversation, repaired (role, text) rows at this place, whether it ends here) of a sorted stream
    of (conv, audit or None, role, text): a piece's edits come just before its rows."""
    conv, edits, last = None, "", ""

    def fill(role: str) -> tuple[str, str]:
        return role, ""

    def inserted() -> list[tuple[str, str]]:
        nonlocal edits, last
        out = []
        while edits.startswith("I"):
            last = "assistant" if last[:1] == "u" else "user"
            out.append(fill(last))
            edits = edits[1:]
        return out

    for name, audit, role, text in stream:
        if name != conv:
            if conv is not None:
                yield conv, inserted(), True
            conv, edits, last = name, "", ""
        if audit is not None:
            edits += audit
            continue
        out = inserted()
        edit, edits = edits[:1], edits[1:]
        if edit == "R":
            role = "assistant" if last[:1] == "u" else "user"
        if edit != "D":
            out.append((role, text))
            last = role
        yield conv, out, False
    if conv is not None:
        yield conv, inserted(), True


def _with_edits(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Edits and rows, each conversation in one sorted stream."""
    both = places.select(*ORDER, "task", "number", "audit", F.lit(None).cast("string").alias("text")).unionByName(
        rows.select("conv", "has_turn", F.col("turn").cast("string").alias("turn"), "role", "key",
                    F.lit(None).cast("int").alias("task"), F.lit(None).cast("bigint").alias("number"),
                    F.lit(None).cast("string").alias("audit"), "text"))
    turn = F.col("turn").cast(rows.schema["turn"].dataType)
    return both.repartition("conv").sortWithinPartitions("conv", "has_turn", turn, "role", "key", F.col("audit").isNull(),
                                                         "task", "number").select("conv", "audit", "role", "text")


def _streamed(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(batch["conv"], batch["audit"], batch["role"], batch["text"])


def repaired_rows(rows: DataFrame, places: DataFrame) -> DataFrame:
    """``conv`` (JSON of the id), ``position``, ``role``, ``text`` of the repaired conversations."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, out = 0, []
        for conv, made, end in _edited(_streamed(batches)):
            for role, text in made:
                out.append((conv, at, role, text))
                at += 1
            at = 0 if end else at
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=["conv", "position", "role", "text"])
                out = []
        yield pd.DataFrame(out, columns=["conv", "position", "role", "text"])

    return _with_edits(rows, places).mapInPandas(run, "conv string, position long, role string, text string")


def _digests(rows: DataFrame, places: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation's ``role:text`` lines, fed row by row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest, empty, out = hashlib.sha256(), True, []
        for conv, made, end in _edited(_streamed(batches)):
            for role, text in made:
                digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                empty = False
            if end:
                out.append((conv, digest.hexdigest()))
                digest, empty = hashlib.sha256(), True
                if len(out) >= 1000:
                    yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
                    out = []
        yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])

    return _with_edits(rows, places).mapInPandas(run, "conv string, repaired_sha256 string")


def plan_edits(rows: DataFrame, work: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of damaged rows: the faults of narrow rows, the place of every piece with its edits, and cost, audit
    and illegal neighbours of every conversation."""
    symbols = work.stored(_symbols(_keyed(rows)), "symbols")
    pieces = work.stored(_pieces(symbols), "pieces")
    rules, table = re_pair(pieces, work)
    weighed = pieces.join(_matrices(table, rules), "seq")
    chosen = work.stored(_chosen(weighed), "chosen")
    places = pieces.select(*ORDER, "task", "number").join(chosen.filter("number IS NOT NULL").select("task", "number", "audit"),
                                                          ["task", "number"])
    return symbols, places, chosen.filter("number IS NULL").select("conv", "audit", "cost", "illegal")


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``: faults and cheapest repair of ``rows``.

    Columns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. Null texts and roles read as one space; rows without a turn
    come first; rows of one turn go by role, then by the MD5 of the text; equal rows
    are duplicates. Null ids are one conversation. Without rows: zeros, no edits and
    the hash of the empty string. An empty table gives an empty result. The SHA-256
    of a conversation is taken by one task, row by row, whatever its length.
    """
    small_batches(conversations.sparkSession)
    work = Scratch(conversations.sparkSession, "conversation_repair")
    symbols, places, whole = plan_edits(rows, work)
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    more = F.col("copies") - 1
    faults = symbols.groupBy("conv").agg(
        F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "duplicate", F.col("copies")).when(F.col("fault") == "blank", 0).otherwise(more)).alias("duplicate"),
        count(F.col("fault") == "truncated").alias("truncated"))
    turns = symbols.select("conv", "turn").distinct().groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    ids = conversations.select("conv_id").distinct().withColumn("conv", F.to_json(F.struct("conv_id")))
    out = ids.join(turns, "conv", "left").join(faults, "conv", "left").join(whole, "conv", "left") \
        .join(_digests(_keyed(rows), places), "conv", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    out = stored(out.select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                            F.coalesce("audit", F.lit("")).alias("audit"),
                            F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")), "repairs")
    work.close()
    return out
