"""Golden envelopes and the decoding traps (FIXTURES.md)."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas as S
from tidelog.functions import strict
from tidelog.operators import envelope as ENV

# A payload as our tests write it, and a reader schema that it does not fit.
PERSON = T.StructType([T.StructField("given_name", T.StringType(), False),
                       T.StructField("family_name", T.StringType(), False), S.uuid_field("ref", nullable=False)])
MISFIT = T.StructType([T.StructField("given_name", T.StringType(), False),
                       T.StructField("family_name", T.IntegerType(), False), S.uuid_field("ref", nullable=False)])

UUID = "7b4d4a2e-3f0a-4c43-9d0c-6a8f1b2c3d4e"
MD = '"eid": "c0ffee12-3456-4abc-8def-0123456789ab", "occurred_at": "2024-03-01T10:00:00Z", "published_by": "billing_service"'
CORE = f'"given_name": "Ines", "family_name": "Moreau", "ref": "{UUID}"'
BUSINESS = f'{{"metadata": {{{MD}}}, {CORE}}}'
DATA = f'{{"metadata": {{{MD}}}, "data_op": "C", "data": {{{CORE}}}, "data_type": "parcel"}}'
UNDEFINED = f"{{{CORE}}}"
SPAN_OK = ('{"eid":"6f1d2c3b-5a47-4e89-9b10-2d7c8e4f0a61","occurred_at":"2023-11-05T08:30:00Z","span_ctx":'
           '{"ot-tracer-spanid":"00aa11bb22cc33dd","ot-tracer-traceid":"44ee55ff66778899","ot-baggage-team":"blue"}}')
SPAN_BAD = SPAN_OK.replace('"44ee55ff66778899"', "42")


def decode(spark, texts, schema=PERSON):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    return {r["i"]: r for r in ENV.decode_events(df, "raw", schema).collect()}


def test_three_categories(spark):
    out = decode(spark, [BUSINESS, DATA, UNDEFINED])
    b, d, u = out[0], out[1], out[2]
    assert (b.category, b.error) == ("business", None)
    assert b.metadata.eid == "c0ffee12-3456-4abc-8def-0123456789ab"
    assert b.metadata.published_by == "billing_service"
    assert (b.payload.given_name, b.payload.family_name, b.payload.ref) == ("Ines", "Moreau", UUID)
    assert (d.category, d.data_op, d.data_type, d.error) == ("data", "C", "parcel", None)
    assert d.payload.given_name == "Ines"
    assert (u.category, u.metadata, u.error) == ("undefined", None, None)
    assert u.payload.family_name == "Moreau"


def test_bad_reader_schema_fails(spark):
    out = decode(spark, [BUSINESS, UNDEFINED], MISFIT)
    assert out[0].error == "$.family_name: expected int"
    assert out[1].error == "$.family_name: expected int"


@pytest.mark.parametrize("text,category,failed", [
    (f'{{"data_op": "C", {CORE}}}', "undefined", False),                       # data_op without metadata
    (f'{{"metadata": null, {CORE}}}', "undefined", False),                     # null metadata = absent
    (f'{{"metadata": {{"eid": "nope", "occurred_at": "2024-03-01T10:00:00Z"}}, {CORE}}}', "business", True),
    ('[1, 2]', "undefined", True),                                             # not an object
    (DATA.replace('"data_op": "C"', '"data_op": "X"'), "data", True),         # unknown operation
    (DATA.replace('"data_op": "C"', '"data_op": 3'), "data", True),           # non-string operation
    (BUSINESS.replace("10:00:00Z", "10:00:00"), "business", True),             # timestamp without offset
    (BUSINESS + " " + UNDEFINED, None, True),                                  # two roots on one line
    ('{"given_name": "Ines"', None, True),                                     # truncated
    (f'{{"given_name": "Ines", "family_name": 7, "ref": "{UUID}"}}', "undefined", True),  # number as string
])
def test_traps(spark, text, category, failed):
    r = decode(spark, [text])[0]
    assert r.category == category
    assert (r.error is not None) == failed, r.error


def test_span_ctx(spark):
    df = spark.createDataFrame([(SPAN_OK,), (SPAN_BAD,)], "raw string")
    v = strict.parse_line(F.col("raw"))
    val, err = strict.decode(v, S.METADATA)
    rows = df.select(val.alias("md"), err.alias("err")).collect()
    ok, bad = rows
    assert ok.err is None and bad.err == "$.span_ctx: expected string values"
    assert ok.md.span_ctx["ot-tracer-traceid"] == "44ee55ff66778899"
    # re-encode: nulls dropped, same document (variant objects keep keys sorted)
    enc = df.limit(1).select(F.to_json(ENV.metadata_struct(val)).alias("j")).first().j
    assert json.loads(enc) == json.loads(SPAN_OK)
    assert '"occurred_at":"2023-11-05T08:30:00Z"' in enc


def test_event_id_fallback(spark):
    texts = [
        BUSINESS,
        '{"a": {"eid": "11111111-2222-3333-4444-555555555555"}, "eid": "66666666-7777-8888-9999-000000000000"}',
        '{"eid": "not-a-uuid", "b": {"eid": "11111111-2222-3333-4444-555555555555"}}',
        '{"x": 1}',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    d = ENV.decode_events(df, "raw", S.EVENT_PAYLOAD.__class__([]))
    got = {r.i: r.id for r in d.select("i", ENV.event_id(F.col("category"), F.col("metadata"), F.col("raw"))
                                       .alias("id")).collect()}
    assert got[0] == "c0ffee12-3456-4abc-8def-0123456789ab"
    assert got[1] == "11111111-2222-3333-4444-555555555555"   # first hit in document order, any depth
    assert got[2] is None                                      # only the first hit is tried
    assert got[3] is None


def test_encode_roundtrip(spark):
    d = decode(spark, [BUSINESS, DATA, UNDEFINED])
    df = spark.createDataFrame([(BUSINESS,), (DATA,), (UNDEFINED,)], "raw string")
    dec = ENV.decode_events(df, "raw", PERSON)
    enc = dec.select(ENV.encode_event(F.col("category"), F.col("metadata"), F.col("payload"), F.col("data_type"),
                                      F.col("data_op"), ["given_name", "family_name", "ref"]).alias("j")).collect()
    for original, r in zip([BUSINESS, DATA, UNDEFINED], enc):
        assert json.loads(r.j) == json.loads(original)
    assert d[0].category == "business"


def test_error_kind(spark):
    bodies = [
        '{"title":"Not allowed","status":403,"detail":"caller may not read 6f1d2c3b-5a47-4e89-9b10-2d7c8e4f0a61"}',
        '{"title":"Conflict","status":409,"detail":"another request holds the lock","instance":"i-1"}',
        '{"title":"Too many readers","status":429}',
        '{"type":"urn:x:quota","title":"Quota spent","status":507}',
        '{"error":"x","error_description":"y"}',
        "oops",
        "",
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    kinds = [r.k for r in df.select(ENV.error_kind(F.col("body")).alias("k")).collect()]
    assert kinds == ["problem"] * 4 + ["basic", "raw", "none"]


def test_error_bodies_are_parsed_once(spark):
    bodies = ['{"title":"t","status":422,"detail":"d"}', '{"error":"x","error_description":"y"}', '{"title":"t"}',
              '{"title":"t","status":1} {}', "oops", "", None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    found = ENV.with_error_fields(df, "body")
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "")
    assert plan.count("parsejson") == 1
    got = [tuple(r) for r in found.orderBy("i").select("kind", "title", "status", "detail", "error", "text").collect()]
    assert got == [("problem", "t", 422, "d", None, None), ("basic", None, None, None, "x", None),
                   ("raw", None, None, None, None, bodies[2]), ("raw", None, None, None, None, bodies[3]),
                   ("raw", None, None, None, None, "oops"), ("none", *[None] * 5), ("none", *[None] * 5)]
