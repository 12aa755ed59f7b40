"""The scalar dialect as Column expressions, all built-in: strings, dates, numbers, arrays, maps, casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# strings


def strpos(s: Column, sub: Column | str) -> Column:
    """1-based place of sub in s, 0 if it isn't there."""
    return F.locate(sub, s) if isinstance(sub, str) else F.call_function("instr", s, sub)


def match(s: Column, pattern: str) -> Column:
    """Whether the pattern is found in s; arguments in the order (string, pattern)."""
    return s.rlike(pattern)


# dates

UNITS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def date_trunc(unit: str, ts: Column) -> Column:
    """Start of the unit that holds ts, without a zone; weeks begin on Monday."""
    if unit.lower() not in UNITS:
        raise ValueError(f"date_trunc knows {', '.join(UNITS)}, not {unit!r}")
    unit, date = unit.lower(), ts.cast("date")
    if unit in UNITS[:3]:  # of the wall time itself: the built-in would go through the session's zone
        parts = [F.hour(ts), F.minute(ts), F.second(ts)][: 3 - UNITS.index(unit)]
        return date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), *parts)
    return (date if unit == "day" else F.trunc(date, unit)).cast("timestamp_ntz")


def epoch(ts: Column) -> Column:
    """Whole seconds since 1970, of a wall time read as UTC, whatever the session's zone."""
    return F.unix_date(ts.cast("date")).cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


_PARTS = {
    "day": F.dayofmonth, "doy": F.dayofyear, "month": F.month, "year": F.year, "hour": F.hour, "minute": F.minute, "quarter": F.quarter, "second": F.second, "week": F.weekofyear,
    "dow": lambda c: F.dayofweek(c) - 1, "isodow": lambda c: F.weekday(c) + 1, "isoyear": lambda c: F.extract(F.lit("yearofweek"), c), "epoch": epoch,
}


def date_part(unit: str, ts: Column) -> Column:
    """A field of ts. dow counts from Sunday 0, isodow from Monday 1; epoch is in whole seconds."""
    try:
        return _PARTS[unit.lower()](ts)
    except KeyError:
        raise ValueError(f"date_part knows {', '.join(_PARTS)}, not {unit!r}") from None


def to_time_zone(zone: str, ts: Column, source: str = "UTC") -> Column:
    """The wall time in zone when it is ts in source."""
    return F.convert_timezone(F.lit(source), F.lit(zone), ts)


def add_interval(ts: Column, months: int = 0, days: int = 0, seconds: float = 0) -> Column:
    """ts plus calendar months (the day is clamped to the month's last), then days and seconds."""
    moved = ts + F.make_ym_interval(F.lit(0), F.lit(months)) if months else ts
    if days or seconds:
        moved = moved + F.make_dt_interval(F.lit(days), F.lit(0), F.lit(0), F.lit(seconds).cast("decimal(18,6)"))
    return moved


def day_diff(a: Column, b: Column) -> Column:
    """Whole days of 86,400 seconds from a to b, towards zero."""
    seconds = epoch(b) - epoch(a)
    return F.floor(F.abs(seconds) / 86400) * F.signum(seconds).cast("bigint")


# numbers


def int_div(a: Column, b: Column) -> Column:
    """Division of whole numbers that truncates, exact in all 64 bits; null for a zero divisor."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


# arrays


def any_of(x: Column, items: Column) -> Column:
    """x = ANY(items)"""
    return F.array_contains(items, x)


def ne_any(x: Column, items: Column) -> Column:
    """x <> ANY(items): some item differs."""
    return F.exists(items, lambda i: i != x)


def eq_all(x: Column, items: Column) -> Column:
    """x = ALL(items)"""
    return F.forall(items, lambda i: i == x)


def ne_all(x: Column, items: Column) -> Column:
    """x <> ALL(items): no item equals x."""
    return F.forall(items, lambda i: i != x)


def subscript(items: Column, i: int | Column) -> Column:
    """items[i], counted from 1; null beyond the ends and at 0."""
    i = F.lit(i) if isinstance(i, int) else i
    return F.when(i >= 1, F.get(items, i - 1))


def subarray(items: Column, low: int, high: int) -> Column:
    """items[low:high], both ends included."""
    return F.slice(items, low, max(high - low + 1, 0))


def index_of(items: Column, x: Column) -> Column:
    """1-based place of the first x, null if it isn't there."""
    return F.nullif(F.array_position(items, x), F.lit(0).cast("bigint"))


def count_equal(items: Column, x: Column) -> Column:
    return F.size(F.filter(items, lambda i: i == x))


# maps from int keys to numbers


def map_fetch(m: Column, key: Column) -> Column:
    """m[key], null if it isn't there."""
    return F.try_element_at(m, key)


def map_sum_up(m: Column, up_to: Column | None = None) -> Column:
    """Sum of the values, or of those with keys of at most up_to."""
    part = m if up_to is None else F.map_filter(m, lambda k, v: k <= up_to)
    return F.aggregate(F.map_values(part), F.lit(0).cast("bigint"), lambda a, v: a + v)


def map_seed(low: int | Column, high: int | Column, value: Column) -> Column:
    """A map that has value for every key from low to high."""
    keys = F.sequence(F.lit(low) if isinstance(low, int) else low, F.lit(high) if isinstance(high, int) else high)
    return F.map_from_arrays(keys, F.transform(keys, lambda k: value))


def map_accumulate(m: Column, high: Column) -> Column:
    """Dense keys from the first to high, each with the sum of the values up to it; one pass over the keys."""
    keys = F.sequence(F.array_min(F.map_keys(m)), high)
    zero = F.array().cast("array<bigint>")
    sums = F.aggregate(keys, zero, lambda a, k: F.concat(a, F.array(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0).cast("bigint")) + F.coalesce(F.try_element_at(m, k), F.lit(0).cast("bigint")))))
    return F.map_from_arrays(keys, sums)


# casts


def to_uint(x: Column, bits: int, mode: str = "wrap") -> Column:
    """x as an unsigned integer of 8, 16, 32, 64 or 128 bits, in a type that holds it all.

    wrap: modulo 2**bits (128 bits: as it is, within 38 digits). error: an ANSI error if it doesn't fit.
    """
    kinds = {8: "smallint", 16: "int", 32: "bigint", 64: "decimal(20,0)", 128: "decimal(38,0)"}
    if bits not in kinds:
        raise ValueError(f"to_uint knows {', '.join(map(str, kinds))} bits, not {bits}")
    whole = x.cast("decimal(38,0)")
    if bits == 128:
        return whole
    top = F.lit(str(2**bits)).cast("decimal(38,0)")
    if mode == "wrap":
        return F.pmod(whole, top).cast(kinds[bits])
    return F.when((whole >= 0) & (whole < top), whole).otherwise(F.raise_error(F.concat(F.lit(f"out of range for UInt{bits}: "), whole.cast("string"))).cast("decimal(38,0)")).cast(kinds[bits])
