"""Built-in column expressions used across the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it stays
inside whole-stage codegen; there is no Python executed per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Session visit-length buckets in seconds as (label, low, high), low
# inclusive and high exclusive (None = open). A 0 s visit falls in no bucket.
VISIT_BUCKETS = [
    ("1s_3s", 1, 4),
    ("4s_6s", 4, 7),
    ("7s_9s", 7, 10),
    ("10s_30s", 10, 30),
    ("30s_60s", 30, 60),
    ("1m_3m", 60, 180),
    ("3m_10m", 180, 600),
    ("10m_30m", 600, 1800),
    ("30m", 1800, None),
]

# Session step-length (action count) buckets as (label, low, high).
STEP_BUCKETS = [
    ("1_3", 1, 4),
    ("4_6", 4, 7),
    ("7_9", 7, 10),
    ("10_30", 10, 30),
    ("30_60", 30, 60),
    ("60", 60, None),
]

ACTION_TIME_PATTERN = "yyyy-MM-dd H:mm:ss"


def _in_bucket(c: Column, lo: int, hi: int | None) -> Column:
    cond = c >= F.lit(lo)
    return cond if hi is None else cond & (c < F.lit(hi))


def bucket_condition(c: Column, buckets, label: str) -> Column:
    for name, lo, hi in buckets:
        if name == label:
            return _in_bucket(c, lo, hi)
    raise KeyError(label)


def bucket_label(c: Column, buckets) -> Column:
    """Label of the bucket ``c`` falls in, or null when it is in none."""
    expr = None
    for name, lo, hi in buckets:
        cond = _in_bucket(c, lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def half_up_ratio(n: Column, d: Column, places: int = 2) -> Column:
    """``n / d`` rounded half-up to ``places`` decimals, exactly, with integer arithmetic.

    ``((2 * 10^p * n + d) div (2 * d)) / 10^p``. Null when ``d`` is 0 or null.
    """
    scale = 10 ** places
    num = F.lit(2 * scale) * n.cast("bigint") + d.cast("bigint")
    q = F.call_function("div", num, F.lit(2) * d.cast("bigint"))
    return F.when(d.cast("bigint") > 0, q / F.lit(float(scale)))


def half_up_ratio_sql(n: str, d: str, places: int = 2) -> str:
    """SQL-text form of ``half_up_ratio`` over column names (integer ``div``, exact)."""
    scale = 10 ** places
    return (f"CASE WHEN {d} > 0 THEN (({2 * scale} * {n} + {d}) div (2 * {d})) "
            f"/ CAST({scale} AS DOUBLE) END")


def nonempty(c: Column) -> Column:
    """The reference's non-empty string test: not null and not ''."""
    return c.isNotNull() & (c != F.lit(""))


def split_ids(c: Column) -> Column:
    """Comma-separated id list -> array<bigint>; empty or malformed elements are dropped."""
    parts = F.split(c, ",")
    ids = F.transform(parts, lambda x: F.trim(x).try_cast("bigint"))
    return F.filter(ids, lambda x: x.isNotNull())


def parse_action_time(c: Column) -> Column:
    """Parse ``yyyy-MM-dd H:mm:ss`` (hour padded or not) to a timestamp; null if malformed.

    The string-to-timestamp cast accepts one- or two-digit fields and needs no pattern
    formatter, so it is cheaper than ``to_timestamp(c, pattern)``.
    """
    return c.try_cast("timestamp")


def date_hour_key(ts: Column) -> Column:
    """``yyyy-MM-dd_HH`` key of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd_HH")


def minute_key(ts: Column) -> Column:
    """``yyyyMMddHHmm`` key of a timestamp."""
    return F.date_format(ts, "yyyyMMddHHmm")


def pack_record(fields: dict[str, Column]) -> Column:
    """Render columns as the reference's packed record ``k=v|k=v|`` (null -> empty)."""
    parts = []
    for key, col in fields.items():
        parts.append(F.concat(F.lit(key + "="), F.coalesce(col.cast("string"), F.lit("")), F.lit("|")))
    return F.concat(*parts)


def packed_field(record: Column, key: str) -> Column:
    """Value of ``key`` in a packed ``k=v|k=v`` record.

    The first segment ``key=value`` whose value is non-empty and holds no ``=`` but at its
    end wins; otherwise null (the reference's reader skips segments that do not split into
    exactly two parts, and its split drops trailing empty ones).
    """
    pattern = r"(?:^|\|)\Q" + key + r"\E=([^|=]+)=*(?:\||$)"
    v = F.regexp_extract(record, pattern, 1)
    return F.when(v != F.lit(""), v)


def concat_long_string(v: Column, s: Column, sep: str = ":") -> Column:
    """``concat_long_string(id, name, sep)``: ``id<sep>name`` with a null printed as 'null'."""
    return F.concat(F.coalesce(v.cast("string"), F.lit("null")), F.lit(sep),
                    F.coalesce(s, F.lit("null")))


def json_field(js: Column, field: str) -> Column:
    """Field of a JSON object by bare name (the reference's get_json_object UDF)."""
    return F.get_json_object(js, f"$['{field}']")


def group_concat_distinct(c: Column, sep: str = ",") -> Column:
    """Aggregate: distinct non-null values, sorted, joined by ``sep``; null when none.

    ``collect_set`` is partially aggregated map-side, so a hot group ships at most one
    de-duplicated set per map task.
    """
    joined = F.array_join(F.array_sort(F.collect_set(c)), sep)
    return F.when(joined != F.lit(""), joined)
