"""Event envelopes: classify, decode, encode, ids.

An event arrives as JSON of one of three shapes:

* data change: ``{"metadata": {...}, "data_type": ..., "data_op": C|U|D|S, "data": {payload}}``
* business:    ``{"metadata": {...}, <payload fields at the root>}``
* undefined:   ``{<payload fields>}``

``decode_event`` turns one VARIANT into a struct ``(category, data_op,
data_type, metadata, payload, error)``. It is a pure column expression, so it
is used per row *and* inside ``transform`` over the ``events`` array of a
batch (one decode per event, no explode / re-group round trip).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas as S
from tidelog.functions import strict
from tidelog.functions.columns import UUID_PATTERN, offset_ts_string

DECODED_FIELDS = ["category", "data_op", "data_type", "metadata", "payload", "error"]


def _category(v: Column, op: Column, md: Column) -> Column:
    """``data_op`` *and* ``metadata`` present => data; ``metadata`` only
    => business; anything else => undefined, including ``data_op`` without
    ``metadata``. JSON null counts as absent. Shape errors (non-string
    ``data_op``, malformed ``metadata``) are reported by the decoder."""
    has_op, has_md = strict.present(op), strict.present(md)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(has_op & has_md, F.lit("data"))
            .when(has_md, F.lit("business"))
            .otherwise(F.lit("undefined")))


def classify(v: Column) -> Column:
    """Category of an event VARIANT (see ``_category``)."""
    return _category(v, strict.sub(v, "$.data_op"), strict.sub(v, "$.metadata"))


def locate_event(v: Column) -> Column:
    """Decode stage 1: the top-level lookups and the category; the payload
    is ``$.data`` for data events and the root otherwise, so only one
    location is decoded per event."""
    op, md = strict.sub(v, "$.data_op"), strict.sub(v, "$.metadata")
    cat = _category(v, op, md)
    return F.struct(
        v.alias("v"), op.alias("op"), strict.sub(v, "$.data_type").alias("dtype"), md.alias("md"),
        cat.alias("category"), F.when(cat == "data", strict.sub(v, "$.data")).otherwise(v).alias("pv"),
    )


def prepare_event(a: Column, payload_schema: T.StructType) -> Column:
    """Decode stage 2: typed casts and per-field lookups of metadata and payload."""
    return F.struct(
        a["v"].alias("v"), a["op"].alias("op"), a["dtype"].alias("dtype"), a["category"].alias("category"),
        strict.prepare(a["md"], S.METADATA, "$").alias("md"),
        strict.prepare(a["pv"], payload_schema, "$").alias("pl"),
    )


def finish_event(p: Column, payload_schema: T.StructType) -> Column:
    """Decode stage 3: ``(category, data_op, data_type, metadata, payload, error)``
    from a prepared event (P1-P4 + F2)."""
    v, op, dtype, md, pl, category = p["v"], p["op"], p["dtype"], p["md"], p["pl"], p["category"]
    data_type = F.try_variant_get(dtype, "$", "string")
    data_op = F.try_variant_get(op, "$", "string")
    error = F.coalesce(
        F.when(v.isNull(), F.lit("malformed JSON")),
        F.when(strict.present(op) & (strict.vtype(op) != F.lit("STRING")), F.lit("$.data_op: expected a string")),
        F.when(strict.present(md["self"]), strict.check(md, S.METADATA, "$.metadata")),
        F.when(category == "data", F.coalesce(
            strict.check(pl, payload_schema, "$.data"),
            F.when(~strict.present(dtype), F.lit("$.data_type: missing")),
            F.when(strict.vtype(dtype) != F.lit("STRING"), F.lit("$.data_type: expected a string")),
            F.when(~data_op.isin(S.DATA_OPERATIONS), F.lit("$.data_op: not one of " + ",".join(S.DATA_OPERATIONS))),
        )).otherwise(strict.check(pl, payload_schema, "$")),
    )
    return F.struct(
        category.alias("category"),
        F.when(category == "data", data_op).alias("data_op"),
        F.when(category == "data", data_type).alias("data_type"),
        F.when(category != "undefined", md["typed"]).alias("metadata"),
        pl["typed"].alias("payload"),
        error.alias("error"),
    )


def decode_event(v: Column, payload_schema: T.StructType) -> Column:
    """P1-P4 + F2 as one expression (for small inputs; ``decode_events`` and
    ``parse_batches`` run the stages as separate projections)."""
    return finish_event(prepare_event(locate_event(v), payload_schema), payload_schema)


def decode_events(df: DataFrame, raw_col: str, payload_schema: T.StructType) -> DataFrame:
    """Decode a column of event JSON text; adds the ``DECODED_FIELDS`` columns.

    Staged projections separated by generator boundaries: parse once, locate,
    prepare, finish -- the JSON text is parsed a single time per row.
    """
    d = strict.materialize(df, _v=strict.parse_line(F.col(raw_col)))
    d = strict.materialize(d, _a=locate_event(F.col("_v")))
    d = strict.materialize(d, _p=prepare_event(F.col("_a"), payload_schema))
    d = strict.materialize(d, _d=finish_event(F.col("_p"), payload_schema))
    return d.select(*df.columns, *[F.col("_d").getField(n).alias(n) for n in DECODED_FIELDS])


def get_metadata(category: Column, metadata: Column) -> Column:
    """P5: metadata of business / data events, null for undefined."""
    return F.when(category != F.lit("undefined"), metadata)


# Private-use stand-ins for an escaped backslash and an escaped quote: without these
# two every quote of a JSON text opens or closes a string.
_BACKSLASH, _QUOTE = "\ue000", "\ue001"


def _plain_quotes(text: Column) -> Column:
    """JSON text whose strings hold no quote and no escaped backslash."""
    return F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))


def _json_quotes(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def event_id(category: Column, metadata: Column, raw: Column) -> Column:
    """``metadata.eid``, else the first ``eid`` key of an undefined event.

    The fallback takes the first key ``eid``, however its letters are escaped, at
    any depth in document order (a depth-first pre-order walk visits keys in that
    order); ``eid`` inside a string or as the end of a key is not one. Only that
    first hit is tried: when its value is not a UUID string the id is null. (VARIANT
    keeps no document order, so the text is searched: with quotes made plain, a
    string followed by a colon is a key.)
    """
    own = F.when(category != F.lit("undefined"), metadata.getField("eid"))
    text = _plain_quotes(raw)
    for letter in "eid":
        text = F.replace(text, F.lit(f"\\u{ord(letter):04x}"), F.lit(letter))
    # between two strings of a JSON text there are no letters e, i, d: the match is one whole string
    hit = F.regexp_extract(text, r'"eid"\s*+:\s*+("[^"]*+"|[^"])', 1)
    value = F.try_variant_get(F.try_parse_json(hit), "$", "string")
    fallback = F.when(value.rlike(UUID_PATTERN), value)
    return F.coalesce(own, F.when(category == F.lit("undefined"), fallback))


# ---------------------------------------------------------------------------
# Encoding (F1)
# ---------------------------------------------------------------------------

def metadata_struct(md: Column) -> Column:
    """Metadata as it goes on the wire: timestamps as ISO text with offset."""
    return F.struct(
        md.getField("eid").alias("eid"),
        offset_ts_string(md.getField("occurred_at")).alias("occurred_at"),
        md.getField("event_type").alias("event_type"),
        offset_ts_string(md.getField("received_at")).alias("received_at"),
        md.getField("parent_eids").alias("parent_eids"),
        md.getField("flow_id").alias("flow_id"),
        md.getField("partition").alias("partition"),
        md.getField("partition_compaction_key").alias("partition_compaction_key"),
        md.getField("span_ctx").alias("span_ctx"),
        md.getField("published_by").alias("published_by"),
    )


def encode_event(category: Column, metadata: Column, payload: Column, data_type: Column,
                 data_op: Column, payload_fields: list[str],
                 payload_metadata_fields: list[str] | None = None) -> Column:
    """event row -> JSON text; null fields are dropped.

    business  = payload deep-merged with ``{"metadata": ...}``, metadata wins:
                when the payload has its own ``metadata`` object
                (``payload_metadata_fields`` names its keys), its keys that
                are not envelope keys are kept, the envelope's keys replace
                the rest (a null envelope value removes the key, as the
                merged null is dropped when printing)
    data      = ``{"data", "data_type", "data_op", "metadata"}``
    undefined = payload only
    """
    md = metadata_struct(metadata)
    if payload_metadata_fields:
        own = {f.name for f in S.METADATA.fields}
        extra = [payload.getField("metadata").getField(k).alias(k) for k in payload_metadata_fields if k not in own]
        md = F.struct(*[md.getField(f.name).alias(f.name) for f in S.METADATA.fields], *extra)
    fields = [payload.getField(n).alias(n) for n in payload_fields if n != "metadata"]
    business = F.to_json(F.struct(*fields, md.alias("metadata")))
    data = F.to_json(F.struct(payload.alias("data"), data_type.alias("data_type"),
                              data_op.alias("data_op"), md.alias("metadata")))
    undefined = F.to_json(payload)
    return (F.when(category == "data", data).when(category == "business", business).otherwise(undefined))


def _without_nulls(text: Column) -> Column:
    """Compact JSON text without its null keys, at any depth."""
    plain = _plain_quotes(text)
    kept = F.regexp_replace(plain, r'("[^"]*+"(?!:null\b))|"[^"]*+":null,?', "$1")
    return _json_quotes(F.regexp_replace(kept, r'("[^"]*+")|,(?=\})', "$1"))


def encode_event_text(category: Column, metadata: Column, payload: Column, data_type: Column, data_op: Column) -> Column:
    """F1 for payloads of any shape: ``payload`` is JSON text (an object).

    As ``encode_event``, but no key has to be named: a business payload's own
    ``metadata`` object is merged with the envelope's, key by key. The envelope
    wins, also with a null (the key goes); where both have a ``span_ctx`` object
    those are merged in the same way; other keys stay. Keys are printed in
    order of their names, null keys are dropped at any depth. A payload that is
    not an object gives null (malformed: null).
    """
    objects = "map<string,variant>"
    root = F.try_variant_get(F.try_parse_json(payload), "$", objects)
    envelope = F.try_variant_get(F.try_parse_json(F.to_json(metadata_struct(metadata))), "$", objects)
    own = F.coalesce(F.try_variant_get(F.element_at(root, "metadata"), "$", objects), F.create_map().cast(objects))
    names = [f.name for f in S.METADATA.fields]
    kept = F.map_filter(own, lambda k, _: ~k.isin(names))
    span, own_span = (F.try_variant_get(F.element_at(m, "span_ctx"), "$", objects) for m in (envelope, own))
    spans = F.map_concat(F.map_filter(own_span, lambda k, _: ~F.map_contains_key(span, k)), span)
    merged_span = F.when(span.isNotNull() & own_span.isNotNull(), F.to_json(spans)).when(span.isNotNull(), F.to_json(span))
    rest = F.map_concat(F.map_filter(envelope, lambda k, _: k != "span_ctx"), kept)
    merged = F.when(merged_span.isNull(), rest).otherwise(
        F.map_concat(rest, F.create_map(F.lit("span_ctx"), F.try_parse_json(merged_span))))

    def printed(m: Column) -> Column:
        return F.to_json(F.try_parse_json(F.to_json(m)))

    business = printed(F.map_concat(F.map_filter(root, lambda k, _: k != "metadata"),
                                    F.create_map(F.lit("metadata"), F.try_parse_json(F.to_json(merged)))))
    data = F.to_json(F.struct(F.try_parse_json(payload).alias("data"), data_op.alias("data_op"), data_type.alias("data_type"),
                              F.try_parse_json(F.to_json(envelope)).alias("metadata")))
    return F.when(root.isNotNull(), _without_nulls(
        F.when(category == "data", data).when(category == "business", business).otherwise(printed(root))))


def fill_metadata(df: DataFrame, name_col: str = "event_type", enabled: bool = True) -> DataFrame:
    """``metadata.event_type = coalesce(own, name)`` for business / data."""
    if not enabled:
        return df
    filled = F.col("metadata").withField(
        "event_type", F.coalesce(F.col("metadata.event_type"), F.col(name_col)))
    return df.withColumn("metadata", F.when(F.col("category").isin("business", "data"), filled)
                         .otherwise(F.col("metadata")))


def default_metadata(eid: Column | None = None, occurred_at: Column | None = None) -> Column:
    """Metadata of a new event: random eid and the current time unless given."""
    return F.struct(
        (F.coalesce(eid, F.expr("uuid()")) if eid is not None else F.expr("uuid()")).alias("eid"),
        (occurred_at if occurred_at is not None else F.current_timestamp()).alias("occurred_at"),
    )


def default_flow_id(flow_id: Column | None = None) -> Column:
    """The caller's flow id, else a random UUID string."""
    return F.coalesce(flow_id, F.expr("uuid()")) if flow_id is not None else F.expr("uuid()")


# ---------------------------------------------------------------------------
# Server errors (F3) and span contexts (F8)
# ---------------------------------------------------------------------------

def error_kind(body: Column) -> Column:
    """classify an error body.

    empty => ``none``; a Problem (title and status required) => ``problem``;
    else ``{"error", "error_description"}`` => ``basic``; else ``raw``.
    """
    v = strict.parse_line(body)
    _, p_err = strict.decode(v, S.PROBLEM)
    _, b_err = strict.decode(v, S.BASIC_SERVER_ERROR)
    return _error_kind(body, v, p_err, b_err)


def _error_kind(body: Column, v: Column, problem_error: Column, basic_error: Column) -> Column:
    return (F.when(body.isNull() | (body == F.lit("")), F.lit("none"))
            .when(v.isNotNull() & problem_error.isNull(), F.lit("problem"))
            .when(v.isNotNull() & basic_error.isNull(), F.lit("basic"))
            .otherwise(F.lit("raw")))


def with_error_fields(df: DataFrame, body_col: str) -> DataFrame:
    """adds ``kind`` (see ``error_kind``) and the fields of that kind: a problem's (type, title,
    status, detail, instance), a basic error's (error, error_description), or the raw text as ``text``;
    the others are null. A body is parsed once: value, lookups and checks are stages of their own."""
    x = strict.materialize(df, _v=strict.parse_line(F.col(body_col)))
    x = strict.materialize(x, _p=strict.prepare(F.col("_v"), S.PROBLEM), _b=strict.prepare(F.col("_v"), S.BASIC_SERVER_ERROR))
    x = strict.materialize(x, _kind=_error_kind(F.col(body_col), F.col("_v"), strict.check(F.col("_p"), S.PROBLEM),
                                                strict.check(F.col("_b"), S.BASIC_SERVER_ERROR)))
    kind = F.col("_kind")
    return x.select(*df.columns, kind.alias("kind"),
                    *[F.when(kind == "problem", F.col(f"_p.typed.{f.name}")).alias(f.name) for f in S.PROBLEM.fields],
                    *[F.when(kind == "basic", F.col(f"_b.typed.{f.name}")).alias(f.name) for f in S.BASIC_SERVER_ERROR.fields],
                    F.when(kind == "raw", F.col(body_col)).alias("text"))


def span_ctx_value(span_ctx: Column, key: str) -> Column:
    """F8: one entry of a span context map."""
    return F.element_at(span_ctx, F.lit(key))
