"""The scalar dialect by its own names, as temporary SQL functions for statements in text."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name, parameters with types, result type, body. Aggregates cannot be SQL functions: see quarry.functions.dialect, and quarry.operators.aggregates for Columns.
FUNCTIONS: list[tuple[str, str, str, str]] = [
    ("toUInt8", "x string", "smallint", "cast(pmod(cast(x as decimal(38,0)), 256) as smallint)"),
    ("toUInt16", "x string", "int", "cast(pmod(cast(x as decimal(38,0)), 65536) as int)"),
    ("toUInt32", "x string", "bigint", "cast(pmod(cast(x as decimal(38,0)), 4294967296) as bigint)"),
    ("toUInt64", "x string", "decimal(20,0)", "cast(pmod(cast(x as decimal(38,0)), cast('18446744073709551616' as decimal(38,0))) as decimal(20,0))"),
    ("toUInt128", "x string", "decimal(38,0)", "cast(x as decimal(38,0))"),
    ("trimBoth", "s string", "string", "btrim(s)"),
    ("positionOf", "s string, part string", "int", "instr(s, part)"),
    ("match", "s string, pattern string", "boolean", "regexp_like(s, pattern)"),
    ("toStartOfSecond", "t timestamp_ntz", "timestamp_ntz", "cast(cast(t as date) as timestamp_ntz) + make_dt_interval(0, hour(t), minute(t), second(t))"),
    ("toStartOfMinute", "t timestamp_ntz", "timestamp_ntz", "cast(cast(t as date) as timestamp_ntz) + make_dt_interval(0, hour(t), minute(t), 0)"),
    ("toStartOfHour", "t timestamp_ntz", "timestamp_ntz", "cast(cast(t as date) as timestamp_ntz) + make_dt_interval(0, hour(t), 0, 0)"),
    ("toStartOfDay", "t timestamp_ntz", "timestamp_ntz", "cast(cast(t as date) as timestamp_ntz)"),
    ("toMonday", "t timestamp_ntz", "timestamp_ntz", "cast(trunc(cast(t as date), 'week') as timestamp_ntz)"),
    ("toStartOfMonth", "t timestamp_ntz", "timestamp_ntz", "cast(trunc(cast(t as date), 'month') as timestamp_ntz)"),
    ("toStartOfQuarter", "t timestamp_ntz", "timestamp_ntz", "cast(trunc(cast(t as date), 'quarter') as timestamp_ntz)"),
    ("toStartOfYear", "t timestamp_ntz", "timestamp_ntz", "cast(trunc(cast(t as date), 'year') as timestamp_ntz)"),
    ("toDayOfWeek", "t timestamp_ntz", "int", "weekday(t) + 1"),
    ("toISOYear", "t timestamp_ntz", "int", "extract(yearofweek from t)"),
    ("toISOWeek", "t timestamp_ntz", "int", "weekofyear(t)"),
    ("toUnixTimestamp", "t timestamp_ntz", "bigint", "unix_date(cast(t as date)) * 86400L + hour(t) * 3600 + minute(t) * 60 + second(t)"),
    ("toTimeZone", "t timestamp_ntz, zone string", "timestamp_ntz", "convert_timezone('UTC', zone, t)"),
    ("has", "items array<bigint>, x bigint", "boolean", "array_contains(items, x)"),
    ("countEqual", "items array<bigint>, x bigint", "int", "size(filter(items, i -> i = x))"),
    ("indexOf", "items array<bigint>, x bigint", "bigint", "array_position(items, x)"),
]


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session; returns their names."""
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"create or replace temporary function {name}({parameters}) returns {result} return {body}")
    return [f[0] for f in FUNCTIONS]
