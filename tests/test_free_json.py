"""Free JSON: ids at any depth (P9), merged envelopes (F1), schemas by type (P18), keys by path."""

import json
import random

from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.operators import envelope as ENV
from tidelog.operators import publish as PUB

UUIDS = [f"{i:08x}-1111-4222-8333-944444444444" for i in range(4)]


def first_eid(x):
    """(found, value) of the first key ``eid`` in document order."""
    if isinstance(x, dict):
        for k, v in x.items():
            hit = (True, v) if k == "eid" else first_eid(v)
            if hit[0]:
                return hit
    for v in x if isinstance(x, list) else []:
        if first_eid(v)[0]:
            return first_eid(v)
    return False, None


def anything(rng, depth=0):
    kind = rng.random()
    if depth < 4 and kind < 0.45:
        names = ["a", "eid", 'x"eid', "my eid", "é\\", "eid\n", '":', "b"]
        return {k: anything(rng, depth + 1) for k in rng.sample(names, rng.randint(0, 4))}
    if depth < 4 and kind < 0.6:
        return [anything(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([1, None, True, 2.5, '"eid":"x"', "eid", "\\", 'q"', "", *UUIDS])


def test_event_id_against_a_walk(spark):
    rng = random.Random(2)
    docs = [anything(rng) for _ in range(600)]
    texts = [json.dumps(d, ensure_ascii=i % 2 == 0, indent=1 if i % 5 == 0 else None) for i, d in enumerate(docs)]
    texts = [t.replace('"eid"', '"\\u0065i\\u0064"') if i % 3 == 0 else t for i, t in enumerate(texts)]
    texts.append('{"k":"' + "\\\"eid\\\" \\\\" * 200_000 + '","eid":"' + UUIDS[0] + '"}')
    df = spark.createDataFrame(list(enumerate(texts)), "n int, raw string")
    got = {r.n: r.id for r in df.select("n", ENV.event_id(F.lit("undefined"), F.lit(None).cast(S.plain(S.METADATA)), F.col("raw")).alias("id")).collect()}
    want = {i: v if isinstance(v, str) and v in UUIDS else None for i, v in ((i, first_eid(json.loads(t))[1]) for i, t in enumerate(texts))}
    assert got == want and sum(v is not None for v in want.values()) > 30


def drop_nulls(x):
    if isinstance(x, dict):
        return {k: drop_nulls(v) for k, v in x.items() if v is not None}
    return [drop_nulls(v) for v in x] if isinstance(x, list) else x


def merge(a, b):
    out = dict(a)
    for k, v in b.items():
        out[k] = merge(a[k], v) if isinstance(a.get(k), dict) and isinstance(v, dict) else v
    return out


def test_encoded_text_against_a_merge(spark):
    rng = random.Random(6)
    envelope = {f.name: None for f in S.METADATA.fields} | {"eid": UUIDS[0], "occurred_at": "2024-05-06T07:08:09Z", "partition": "3"}
    rows = []
    for i in range(200):
        payload = {k: anything(rng) for k in rng.sample(["a", "b", 'c"', "d\\"], rng.randint(0, 4))}
        if i % 3:
            payload["metadata"] = {"eid": 1, "flow_id": "own", "x": anything(rng), "span_ctx": rng.choice([None, {"p": "1", "q": "2"}, "text"])}
        if i % 7 == 1:
            payload["metadata"] = rng.choice(["text", [1], None])
        span = {"q": "own", "r": 'a"b'} if i % 2 else None
        rows.append((i, ["business", "data", "undefined"][i % 3], json.dumps(payload, indent=1 if i % 2 else None), span))
    md = "struct('%s' AS eid, timestamp'2024-05-06 07:08:09' AS occurred_at, CAST(null AS string) AS event_type, CAST(null AS timestamp) AS received_at, " \
         "CAST(null AS array<string>) AS parent_eids, CAST(null AS string) AS flow_id, '3' AS partition, CAST(null AS string) AS partition_compaction_key, " \
         "span AS span_ctx, CAST(null AS string) AS published_by)" % UUIDS[0]
    df = spark.createDataFrame(rows, "n int, category string, payload string, span map<string,string>").withColumn("md", F.expr(md))
    got = {r.n: json.loads(r.t) for r in df.select("n", ENV.encode_event_text(
        F.col("category"), F.col("md"), F.col("payload"), F.lit("t"), F.lit("C")).alias("t")).collect()}
    for n, category, payload, span in rows:
        body, env = json.loads(payload), envelope | {"span_ctx": span}
        want = merge(body, {"metadata": env}) if category == "business" else body if category == "undefined" else \
            {"data": body, "data_type": "t", "data_op": "C", "metadata": env}
        assert got[n] == drop_nulls(want), n
    bad = spark.createDataFrame([("[1]",), ("{",), (None,)], "p string").withColumn("span", F.lit(None).cast("map<string,string>"))
    assert [r[0] for r in bad.select(ENV.encode_event_text(F.lit("business"), F.expr(md), F.col("p"), F.lit("t"), F.lit("C"))).collect()] == [None] * 3


def test_schema_of_the_type(spark):
    schema = PUB.struct_of_schema(json.dumps({"type": "object", "required": ["id", "at"], "properties": {
        "id": {"type": "string", "format": "uuid"}, "at": {"type": "string", "format": "date-time"}, "n": {"type": "integer"},
        "tags": {"type": "array", "items": {"type": "string"}}, "state": {"type": "string", "enum": ["on", "off"]},
        "place": {"type": "object", "required": ["x"], "properties": {"x": {"type": "number"}}}, "any": {}}}))
    good = {"id": UUIDS[0], "at": "2024-01-01T00:00:00Z", "n": 3, "tags": ["a"], "state": "on", "place": {"x": 1.5}, "any": [1]}
    cases = [({}, None), ({"id": "x"}, "$.id: not a UUID"), ({"id": None}, "$.id: missing"), ({"at": "2024-01-01T00:00:00"}, "$.at: expected a timestamp with offset"),
             ({"n": 2.5}, "$.n: expected bigint"), ({"tags": [1]}, "$.tags: expected strings"), ({"state": "no"}, "$.state: not one of on,off"),
             ({"place": {}}, "$.place.x: missing"), ({"more": 1, "any": None}, None)]
    text = json.dumps({"type": "object", "required": ["id"], "properties": {"id": {"type": "integer"}}})
    reg = spark.createDataFrame([("strict", None), ("other", text), ("open", None), ("odd", None)], "name string, schema string")
    reg = reg.withColumn("schema", F.when(F.col("name") == "strict", json.dumps(json.loads(json.dumps({
        "type": "object", "required": ["id"], "properties": {"id": {"type": "string"}}})))).otherwise(F.col("schema")))
    rows = [("strict", "business", '{"id":"a"}'), ("other", "business", '{"id":"a"}'), ("other", "data", '{"data":{"id":4}}'),
            ("other", "data", '{"data":7}'), ("open", "undefined", "[1]"), ("open", "undefined", "{}"), ("none", "undefined", "{}"), ("open", "undefined", "{")]
    got = PUB.with_type_validation(spark.createDataFrame(rows, "event_type string, category string, raw string"), reg).collect()
    assert [r.validation_error for r in got] == [None, "$.id: expected bigint", None, "$.data: expected an object", "$: expected an object",
                                                 None, None, "malformed JSON"]
    from tidelog.functions import strict
    df = spark.createDataFrame([(json.dumps(good | c),) for c, _ in cases], "raw string")
    x = strict.materialize(strict.materialize(df, v=strict.parse_line(F.col("raw"))), p=strict.prepare(F.col("v"), schema))
    assert [r[0] for r in x.select(strict.check(F.col("p"), schema)).collect()] == [e for _, e in cases]


def test_partition_keys_by_path(spark):
    rows = [(i, "t", "data" if i % 2 else "business", raw) for i, raw in enumerate([
        '{"a":{"b":1},"c":"x"}', '{"data":{"a":{"b":1},"c":"x"}}', '{"a":{"b":2},"c":"x"}', '{"data":{"a":{},"c":"x"}}',
        '{"a":{"b":null},"c":"x"}', '{"data":{"a":7,"c":"x"}}', '{"c":"x"}', '{"a":{"b":1},"c":"x"}'])]
    df = spark.createDataFrame(rows, "n int, event_type string, category string, raw string") \
        .withColumn("metadata", F.lit(None).cast(S.plain(S.METADATA)))
    reg = spark.createDataFrame([("t", "hash", ["a.b", "c"], 1000)],
                                "name string, partition_strategy string, partition_key_fields array<string>, n_partitions int")
    got = sorted(PUB.assign_partition(df, reg).collect())
    assert got[0].partition == got[1].partition is not None and got[2].partition not in (None, got[0].partition)
    assert [r.partition_error for r in got] == [None] * 3 + ["partition key missing: a.b"] * 5
    none = PUB.assign_partition(df, reg.withColumn("partition_key_fields", F.lit(None).cast("array<string>"))).collect()
    assert {r.partition_error for r in none} == {"partition key missing: no key fields"}
