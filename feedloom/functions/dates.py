"""Date functions as column expressions. The clock is always a parameter; texts are read by a finite list of formats."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.binding import let
from feedloom.functions.terms import AM_MARKERS, PM_MARKERS, RELATIVE_UNITS, SINHALA_MONTHS, TAMIL_MONTHS, literal_map

LOCAL_ZONE = "+05:30"
_RELATIVE = r"(?i)\b(?:(\d{1,3})|(an?))\s+(sec|second|min|minute|hr|hour|day|week)s?\s+ago\b"


def local_date(t: Column) -> Column:
    """Sinhala and Tamil dates at +05:30: month by name in table order, year 20xx, then time, then day; null if they are no date."""
    return let(t, _local_date)


def _local_date(t: Column) -> Column:
    months = SINHALA_MONTHS + TAMIL_MONTHS
    month = F.when(F.lit(False), F.lit(None).cast("int"))
    for name, number in months:
        month = month.when(t.contains(name), F.lit(number))
    year = F.regexp_extract(t, r"\b(20\d{2})\b", 1)
    rest = F.regexp_replace(t, r"(?s)^(.*?)\b20\d{2}\b", "$1 ")
    clock = r"(\d{1,2})[:.](\d{2})"
    timed = rest.rlike(clock)
    hour, minute = F.regexp_extract(rest, clock, 1).try_cast("int"), F.regexp_extract(rest, clock, 2).try_cast("int")
    rest = F.regexp_replace(rest, r"(?s)^(.*?)\d{1,2}[:.]\d{2}", "$1 ")
    day = F.regexp_extract(rest, r"\b(\d{1,2})\b", 1).try_cast("int")
    low = F.lower(t)
    any_of = lambda marks: reduce(or_, [low.contains(m) for m in marks])
    hour24 = F.when(any_of(AM_MARKERS), F.when(hour == 12, 0).otherwise(hour)).when(any_of(PM_MARKERS) & (hour < 12), hour + 12).otherwise(hour)
    made = F.try_make_timestamp(years=year.try_cast("int"), months=month.otherwise(None), days=day, hours=F.when(timed, hour24).otherwise(0), mins=F.when(timed, minute).otherwise(0), secs=F.lit(0).cast("decimal(16,6)"))
    return F.to_utc_timestamp(made, LOCAL_ZONE)


def relative_date(t: Column, now: Column) -> Column:
    """'just now', 'yesterday', '5 hours ago' and the like before now; null for other texts."""
    return let(F.lower(F.trim(t)), lambda low: _relative_date(low, now))


def _relative_date(low: Column, now: Column) -> Column:
    count = F.when(F.regexp_extract(low, _RELATIVE, 1) != "", F.regexp_extract(low, _RELATIVE, 1).try_cast("bigint")).otherwise(F.lit(1).cast("bigint"))
    unit = F.try_element_at(literal_map(list(RELATIVE_UNITS.items())), F.regexp_extract(low, _RELATIVE, 3))
    ago = lambda s: F.timestamp_micros(F.unix_micros(now) - s.cast("bigint") * 1_000_000)
    return F.when(low.isin("just now", "moments ago", "a moment ago", "now"), now).when(low == "yesterday", ago(F.lit(86400))).when(low.rlike(_RELATIVE), ago(unit * count))


_FORMATS = ["d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm", "d MMM yyyy", "d MMMM yyyy HH:mm:ss", "d MMMM yyyy HH:mm", "d MMMM yyyy", "MMM d, yyyy HH:mm", "MMM d, yyyy h:mm a", "MMM d, yyyy", "MMMM d, yyyy HH:mm", "MMMM d, yyyy h:mm a", "MMMM d, yyyy", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm", "yyyy/MM/dd"]


def general_date(t: Column, naive_zone: str = LOCAL_ZONE) -> Column:
    """ISO 8601 and RFC 822 texts and the formats of _FORMATS; a text without a zone is in naive_zone."""
    return let(F.regexp_replace(F.trim(t), r"^(?i)(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", ""), lambda s: _general_date(s, naive_zone))


def _general_date(s: Column, naive_zone: str) -> Column:
    zone = r"(?i)\s*(Z|UTC|GMT|[+-]\d{2}:?\d{2})$"
    zoned = s.rlike(zone) & s.rlike(r"\d:\d")
    offset = F.when(F.upper(F.regexp_extract(s, zone, 1)).isin("Z", "UTC", "GMT"), "+00:00").otherwise(F.regexp_replace(F.regexp_extract(s, zone, 1), r"^([+-]\d{2}):?(\d{2})$", "$1:$2"))
    bare = F.when(zoned, F.regexp_replace(s, zone, "")).otherwise(s)
    read = let(bare, _read)
    return F.to_utc_timestamp(read, F.when(zoned, offset).otherwise(F.lit(naive_zone)))


def _read(bare: Column) -> Column:
    """A text without zone by the formats that are known."""
    iso = F.when(bare.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?$"), F.try_to_timestamp(F.replace(bare, F.lit("T"), F.lit(" "))))
    return F.coalesce(iso, *(F.try_to_timestamp(bare, F.lit(f)) for f in _FORMATS))


def to_instant(t: Column, now: Column, naive_zone: str = LOCAL_ZONE) -> Column:
    """Local, relative or general date as an instant; null if it is more than 2 days ahead of now or 400 behind."""
    return let(t, lambda x: in_bounds(F.coalesce(local_date(x), relative_date(x, now), general_date(x, naive_zone)), now))


def in_bounds(instant: Column, now: Column) -> Column:
    return let(instant, lambda x: F.when((F.unix_micros(x) - F.unix_micros(now)).between(-400 * 86_400_000_000, 2 * 86_400_000_000), x))


def iso(instant: Column) -> Column:
    """ISO 8601 in UTC with Z; microseconds only where there are any (session time zone UTC)."""
    whole = F.unix_micros(instant) % 1_000_000 == 0
    return F.when(whole, F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def age_micros(instant: Column, now: Column) -> Column:
    return F.unix_micros(now) - F.unix_micros(instant)


def age_hours(instant: Column, now: Column) -> Column:
    return age_micros(instant, now) / F.lit(3.6e9)
