"""Event times: ISO-8601 text with a zone, as microseconds of UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The common form, which is read by the engine's own parser. A text without a zone is no event time.
ZONED = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d:?\d\d)$"
#: All other forms of ISO-8601 with a zone: basic and week dates, hours only, decimal commas, any fraction, offsets with seconds.
_DATE = r"^(\d{4}-\d\d-\d\d|\d{8}|\d{4}-W\d\d(?:-\d)?|\d{4}W\d\d\d?)"
_ZONE = r"(Z|[+-]\d\d(?::\d\d(?::\d\d(?:\.\d+)?)?|\d\d(?:\d\d(?:\.\d+)?)?)?)$"
_TIME = r"\D(\d\d(?::\d\d(?::\d\d(?:[.,]\d+)?)?|\d\d(?:\d\d(?:[.,]\d+)?)?)?)"
HOUR, SLOT, DAY = 3_600_000_000, 300_000_000, 86_400_000_000


def micros(text: Column) -> Column:
    """Microseconds since 1970 UTC; null for null, unzoned or unreadable text (never an error). Fractions beyond microseconds are cut."""
    full = F.when(F.substring(text, 17, 1) == ":", text).otherwise(F.concat(F.substring(text, 1, 16), F.lit(":00"), F.substring(text, 17, 99)))
    # the rarer forms are a lambda, which is no part of the generated code: that stays small enough to be compiled to machine code
    return F.when(text.rlike(ZONED), F.unix_micros(F.try_to_timestamp(full))).when(text.rlike(_DATE + _TIME + _ZONE), F.transform(F.array(text), _other)[0])


def _stamp(day: Column, clock: Column) -> Column:
    """Microseconds of yyyyMMdd and hhmmss with an optional fraction, the later parts of which may lack."""
    whole = F.rpad(F.regexp_extract(clock, r"^\d+", 0), 6, "0")
    return F.unix_micros(F.try_to_timestamp(F.concat(day, whole, F.lit("."), F.rpad(F.regexp_extract(clock, r"\.(\d{1,6})", 1), 6, "0")), F.lit("yyyyMMddHHmmss.SSSSSS")))


def _other(text: Column) -> Column:
    get = lambda k: F.translate(F.regexp_extract(text, _DATE + _TIME + _ZONE, k), ",:-", ".")
    # a week date counts from the Monday of the week of 4 January; of a week that a year hasn't, the date is in another one
    week, day = F.substring(get(1), 6, 2).try_cast("int"), F.coalesce(F.substring(get(1), 8, 1).try_cast("int"), F.lit(1))
    fourth = F.try_to_date(F.concat(F.substring(get(1), 1, 4), F.lit("-01-04")))
    monday = F.date_add(F.trunc(fourth, "week"), (week - 1) * 7)
    of_week = F.when((F.weekofyear(monday) == week) & day.between(1, 7), F.date_format(F.date_add(monday, day - 1), "yyyyMMdd"))
    date = F.when(F.substring(get(1), 5, 1) == "W", of_week).otherwise(get(1))
    sign = F.when(F.contains(F.regexp_extract(text, _DATE + _TIME + _ZONE, 3), F.lit("-")), -1).otherwise(1)
    zone = F.translate(get(3), "+Z", "")
    return _stamp(date, get(2)) - sign * _stamp(F.lit("19700101"), zone)


def micros_ntz(stamp: Column) -> Column:
    """Microseconds of a timestamp column, with or without zone, read as UTC (the session's zone is UTC)."""
    return F.unix_micros(stamp.cast("timestamp"))


def iso_seconds(us: Column) -> Column:
    """Like 2024-01-01T05:00:00Z."""
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_micros(us: Column) -> Column:
    """Like 2024-01-01T05:00:00.000000Z, the contract's normal form."""
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def floor_to(us: Column, width: int) -> Column:
    """Start of the period of width microseconds that holds us (also before 1970)."""
    return us - F.pmod(us, F.lit(width))
