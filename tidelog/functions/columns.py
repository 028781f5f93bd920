"""Scalar column expressions (P12, F4-F9, X1 hash). All JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog import schemas as S

# Fixed patterns
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
# ISO-8601 local date-time followed by a mandatory zone offset (Z or +HH:MM[:SS]); case-insensitive T / Z
OFFSET_TS_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?([Zz]|[+-]\d{2}:\d{2}(:\d{2})?)$"
)
BEARER_PATTERN = r"Bearer \S+"
BEARER_MASK = "Bearer <secret>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_uuid(c) -> Column:
    """True when the string is a UUID; null stays null."""
    return _c(c).rlike(UUID_PATTERN)


def is_enum(c, values: list[str]) -> Column:
    """Closed value set."""
    return _c(c).isin(list(values))


def offset_num(c) -> Column:
    """numeric offset of a cursor; ``BEGIN`` precedes every event (-1)."""
    c = _c(c)
    return F.when(c == F.lit(S.BEGIN_OFFSET), F.lit(-1).cast("bigint")).otherwise(c.try_cast("bigint"))


def offset_sql(c: str) -> str:
    """``offset_num`` as SQL text, for the column expression ``c``."""
    return f"CASE WHEN {c} = '{S.BEGIN_OFFSET}' THEN -1L ELSE try_cast({c} AS bigint) END"


def parse_offset_ts(c) -> Column:
    """ISO timestamp that must carry an offset; anything else is null."""
    c = _c(c)
    return F.when(c.rlike(OFFSET_TS_PATTERN), F.try_to_timestamp(F.upper(c)))


def has_offset(c) -> Column:
    return _c(c).rlike(OFFSET_TS_PATTERN)


def seconds(c) -> Column:
    """whole seconds of a day-time interval, truncating toward zero."""
    return _c(c).cast("interval second").cast("long")


def interval_of_seconds(c) -> Column:
    """F6, other direction: whole seconds to a day-time interval."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(c).cast("decimal(18,6)"))


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end``, truncating toward zero."""
    micros = F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp"))
    return (micros / F.lit(1_000_000)).cast("bigint")


def mask_token(c, enabled: bool = True) -> Column:
    """hide bearer tokens in log lines."""
    c = _c(c)
    return F.regexp_replace(c, BEARER_PATTERN, BEARER_MASK) if enabled else c


def backoff_delay_ms(k, initial_ms: float = S.BACKOFF_INITIAL_MS, factor: float = S.BACKOFF_FACTOR) -> Column:
    """wait before retry round ``k`` (0-based).

    Each round multiplies the previous wait by ``factor ** k``, so the waits
    compound: ``initial * factor ** (k * (k + 1) / 2)``.
    """
    k = _c(k).cast("double")
    return F.lit(float(initial_ms)) * F.pow(F.lit(float(factor)), k * (k + F.lit(1.0)) / F.lit(2.0))


def md5_uuid(c) -> Column:
    """Deterministic UUID-formatted id from the md5 of a value (fixture ids)."""
    h = F.md5(_c(c).cast("string"))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )


def md5_bucket(c, n: int) -> Column:
    """X1 hash: ``md5-prefix(value) mod n``; repeatable in any SQL engine with md5."""
    h = F.conv(F.substring(F.md5(_c(c).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n))


def offset_ts_string(c) -> Column:
    """Encode a timestamp as ISO-8601 in UTC with offset ``Z``, the way an
    offset date-time prints: seconds always, the fraction only when non-zero
    and without trailing zeros (``10:00:00Z``, ``05:37:01.771839Z``)."""
    ts = _c(c).cast("timestamp")
    frac = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    digits = F.regexp_replace(F.lpad(frac.cast("string"), 6, "0"), "0+$", "")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac != 0, F.concat(F.lit("."), digits)).otherwise(F.lit("")), F.lit("Z"))
