"""Property: the strict decoder accepts exactly the documents a typed reader
accepts (string fields must be JSON strings, integers must be integral
numbers, required fields present and non-null, ids UUIDs, unknown keys
ignored). Several hundred generated documents, one Spark job."""

import json
import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import strict

SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("count", T.LongType(), True),
    T.StructField("ratio", T.DoubleType(), True),
    T.StructField("id", T.StringType(), True, {"format": "uuid"}),
    T.StructField("tags", T.ArrayType(T.StringType()), True),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("inner", T.StructType([T.StructField("x", T.LongType(), False)]), True),
])
UUID_RE = re.compile(r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")
VALUES = ["s", "7", {"k": None}, [None], "", 0, 7, -3, 2.5, True, None, [], ["a"], [1], {}, {"x": 1}, {"x": "1"}, {"k": "v"}, {"k": 2},
          "6f1d2c3b-5a47-4e89-9b10-2d7c8e4f0a61"]


def is_int(v):
    return isinstance(v, int) and not isinstance(v, bool)


def reference_ok(doc) -> bool:
    if not isinstance(doc, dict):
        return False
    checks = {
        "name": lambda v: isinstance(v, str),
        "count": is_int,
        "ratio": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
        "id": lambda v: isinstance(v, str) and bool(UUID_RE.match(v)),
        "tags": lambda v: isinstance(v, list) and all(isinstance(x, str) for x in v),
        "attrs": lambda v: isinstance(v, dict) and all(isinstance(x, str) for x in v.values()),
        "inner": lambda v: isinstance(v, dict) and is_int(v.get("x")),
    }
    if doc.get("name") is None:
        return False
    return all(doc.get(k) is None or f(doc[k]) for k, f in checks.items())


def test_strict_matches_reference(spark):
    rnd = random.Random(20261202)
    docs = []
    for _ in range(600):
        d = {"name": "n", "count": rnd.randint(-9, 9), "ratio": rnd.choice([1, 0.5]), "id": VALUES[-1],
             "tags": ["a"], "attrs": {"k": "v"}, "inner": {"x": 3}}
        d = {k: v for k, v in d.items() if rnd.random() < 0.95}
        if rnd.random() < 0.8:
            d[rnd.choice(["name", "count", "ratio", "id", "tags", "attrs", "inner", "extra"])] = rnd.choice(VALUES)
        docs.append(d)
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, raw string")
    df = strict.materialize(df, _v=strict.parse_line(F.col("raw")))
    df = strict.materialize(df, _p=strict.prepare(F.col("_v"), SCHEMA))
    got = {r.i: r.err for r in df.select("i", strict.check(F.col("_p"), SCHEMA).alias("err")).collect()}
    mismatches = [(docs[i], got[i]) for i in range(len(docs)) if (got[i] is None) != reference_ok(docs[i])]
    assert not mismatches, mismatches[:5]
    accepted = sum(e is None for e in got.values())
    assert accepted > 150 and len(docs) - accepted > 150


def test_trailing_text_is_malformed(spark):
    doc = '{"name":"n"}'
    lines = {doc: True, f" {doc} ": True, f"{doc}] junk": False, f"{doc}],[{{}}": False, f"{doc},{{}}": False,
             f"{doc} {doc}": False, f'{doc},"x"] y': False, "": False, "{": False}
    df = spark.createDataFrame([(k,) for k in lines], "raw string")
    got = {r.raw: r.ok for r in df.select("raw", strict.parse_line(F.col("raw")).isNotNull().alias("ok")).collect()}
    assert got == lines
