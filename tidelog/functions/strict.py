"""Strict JSON decoding on top of Spark's VARIANT type.

Spark's ``from_json`` is lenient where a typed reader is not: a number read
into a STRING field becomes text, a timestamp without a zone offset is
accepted, and a second JSON root on the same line is silently dropped. The
reference semantics reject all three. This module decodes a VARIANT against a
``StructType`` and returns, next to the typed value, the *first* violation
(field order, depth first) as a message column -- all built-in expressions,
so decoding stays JVM-side and also works inside ``transform`` lambdas over
arrays of events.

Decoding is split in two stages so nothing is computed twice: ``prepare``
builds one struct per value holding the typed cast and every field's
sub-variant (one path lookup each); ``check`` reads those materialised
fields. Callers put the two stages in separate projections (or nested
``transform`` calls), because Spark does not eliminate common
subexpressions inside lambdas or conditional branches.

Field metadata drives extra checks: ``{"format": "uuid"}``,
``{"format": "offset-date-time"}``, ``{"enum": [...]}``. A non-nullable field
is required (absent or JSON null is a violation); unknown keys are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.columns import OFFSET_TS_PATTERN, UUID_PATTERN
from tidelog.schemas import plain

_SIMPLE_KEY = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def child_path(path: str, name: str) -> str:
    if _SIMPLE_KEY.match(name):
        return f"{path}.{name}"
    return f"{path}['{name}']"


def materialize(df, **cols: Column):
    """Add ``cols`` as real columns computed exactly once per row.

    ``inline(array(struct(...)))`` is a generator, and the optimizer neither
    inlines generator outputs into later expressions nor pushes filters on
    them below it -- so a large decode expression is never duplicated into a
    pushed-down filter or a collapsed projection.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def parse_line(raw: Column) -> Column:
    """Parse one JSON document; null when it is malformed or has trailing data.

    A plain parse stops after the first root and ignores the rest of the line.
    The text is therefore read as the first element of an array whose second
    element is the text's own md5: a second root, closing brackets or any other
    trailing text moves that mark away or out of the array.
    """
    mark = F.md5(raw)
    wrapped = F.try_parse_json(F.concat(F.lit("["), raw, F.lit(',"'), mark, F.lit('"]')))
    # bound by a lambda: the text is parsed once, though its parse is looked at twice
    return F.transform(F.array(wrapped), lambda w: F.when(F.try_variant_get(w, "$[1]", "string") == mark,
                                                          F.try_variant_get(w, "$[0]", "variant")))[0]


def sub(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def present(x: Column) -> Column:
    """Key exists and is not JSON null (absent and null mean the same)."""
    return x.isNotNull() & ~F.coalesce(F.is_variant_null(x), F.lit(False))


def vtype(x: Column) -> Column:
    return F.schema_of_variant(x)


def is_object(x: Column) -> Column:
    return F.try_variant_get(x, "$", "map<string,variant>").isNotNull()


def _walk(schema: T.StructType, path: str = "$"):
    """(variant path, field) of every field, depth first, in field order."""
    for f in schema.fields:
        p = child_path(path, f.name)
        yield p, f
        if isinstance(f.dataType, T.StructType):
            yield from _walk(f.dataType, p)


def prepare(v: Column, schema: T.StructType, base: str = "$") -> Column:
    """Stage 1: ``struct(self, typed, f0, f1, ...)`` for the value at ``base``
    of VARIANT ``v``: the value, its typed cast (null when not an object) and
    each field's sub-variant -- every path looked up from ``v`` directly."""
    ddl = plain(schema).simpleString()
    cols = [(v if base == "$" else sub(v, base)).alias("self"), F.try_variant_get(v, base, ddl).alias("typed")]
    cols += [sub(v, base + p[1:]).alias(f"f{i}") for i, (p, _) in enumerate(_walk(schema))]
    return F.struct(*cols)


def _leaf(field: T.StructField, x: Column, typed: Column, path: str) -> list[Column]:
    dt = field.dataType
    md = field.metadata or {}
    p = present(x)
    out: list[Column] = []
    if isinstance(dt, T.StringType):
        out.append(F.when(p & (vtype(x) != F.lit("STRING")), F.lit(f"{path}: expected a string")))
        if md.get("format") == "uuid":
            out.append(F.when(p & ~typed.rlike(UUID_PATTERN), F.lit(f"{path}: not a UUID")))
        if "enum" in md:
            allowed = list(md["enum"])
            out.append(F.when(p & ~typed.isin(allowed), F.lit(f"{path}: not one of {','.join(allowed)}")))
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        bad = (vtype(x) != F.lit("STRING")) | typed.isNull()
        if md.get("format") == "offset-date-time":
            bad = bad | ~F.try_variant_get(x, "$", "string").rlike(OFFSET_TS_PATTERN)
        out.append(F.when(p & bad, F.lit(f"{path}: expected a timestamp with offset")))
    elif isinstance(dt, T.StructType):
        out.append(F.when(p & typed.isNull(), F.lit(f"{path}: expected an object")))
    elif isinstance(dt, T.ArrayType):
        out.append(F.when(p & typed.isNull(), F.lit(f"{path}: expected an array")))
        if isinstance(dt.elementType, T.StringType):
            elems = F.try_variant_get(x, "$", "array<variant>")
            out.append(F.when(p & F.exists(elems, lambda e: ~present(e) | (vtype(e) != F.lit("STRING"))),
                              F.lit(f"{path}: expected strings")))
            if md.get("format") == "uuid":
                out.append(F.when(p & F.exists(typed, lambda e: ~e.rlike(UUID_PATTERN)),
                                  F.lit(f"{path}: not UUIDs")))
        else:
            out.append(F.when(p & F.exists(typed, lambda e: e.isNull()), F.lit(f"{path}: bad element")))
    elif isinstance(dt, T.MapType):
        out.append(F.when(p & typed.isNull(), F.lit(f"{path}: expected an object")))
        if isinstance(dt.valueType, T.StringType):
            vals = F.map_values(F.try_variant_get(x, "$", "map<string,variant>"))
            out.append(F.when(p & F.exists(vals, lambda e: ~present(e) | (vtype(e) != F.lit("STRING"))),
                              F.lit(f"{path}: expected string values")))
        else:
            out.append(F.when(p & F.exists(F.map_values(typed), lambda e: e.isNull()),
                              F.lit(f"{path}: bad value")))
    else:  # numbers, booleans, dates
        bad = typed.isNull()
        if isinstance(dt, T.BooleanType):
            bad = bad | (vtype(x) != F.lit("BOOLEAN"))
        elif isinstance(dt, T.NumericType):
            bad = bad | ~vtype(x).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
            if isinstance(dt, T.IntegralType):  # 2.0 is a whole number, 2.5 is not
                bad = bad | (F.try_variant_get(x, "$", "double") != typed.cast("double"))
        out.append(F.when(p & bad, F.lit(f"{path}: expected {dt.simpleString()}")))
    return out


def check(prep: Column, schema: T.StructType, display: str = "$") -> Column:
    """Stage 2: the first violation of a prepared value (null when it conforms)."""
    checks = [F.when(prep["typed"].isNull(), F.lit(f"{display}: expected an object"))]
    typed_of: dict[str, Column] = {"$": prep["typed"]}
    present_of: dict[str, Column] = {}
    for i, (p, f) in enumerate(_walk(schema)):
        parent = p[: p.rfind("['")] if p.endswith("']") else p[: p.rfind(".")]
        x = prep[f"f{i}"]
        typed = typed_of[parent].getField(f.name)
        typed_of[p] = typed
        present_of[p] = present(x)
        shown = display + p[1:]
        if not f.nullable:
            miss = ~present(x)
            if parent != "$":
                miss = present_of[parent] & miss
            checks.append(F.when(miss, F.lit(f"{shown}: missing")))
        checks.extend(_leaf(f, x, typed, shown))
    return F.coalesce(*checks)


def decode(v: Column, schema: T.StructType, path: str = "$") -> tuple[Column, Column]:
    """Single-expression decode ``(value, error)`` for light use (few fields,
    already materialised input). Hot paths use ``prepare`` + ``check``."""
    prep = prepare(v, schema, path)
    return prep["typed"], check(prep, schema, path)
