"""Play-time expressions: epoch coercion, calendar fields, day-part buckets."""
from __future__ import annotations

from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column, functions as F

from sonora.fixed_values import (
    NIGHT,
    PLAY_TIME_FORMATS,
    TIME_OF_DAY_BUCKETS,
    ZONE_OFFSETS,
)
from sonora.functions.text import col_

# Formats have no weekday (a date says it already).
_WEEKDAY = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,? "
# A zone name, or a Z or numeric offset right after a time of day.
_ZONE = r" (?!(?:AM|PM)$)[A-Z]{2,5}$|(?<=:[0-9]{2}|\.[0-9]{1,9}) ?(?:Z|[+-][0-9]{2}:?[0-9]{2})$"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _zone_offset(zone: Column) -> Column:
    """Seconds east of UTC.  Names other than the listed ones (and UTC, GMT, Z) count as UTC."""
    names = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in ZONE_OFFSETS.items()))
    number = F.regexp_replace(zone, "[ :]", "").try_cast("int")
    numeric = F.signum(number) * (F.floor(F.abs(number) / 100) * 3600 + F.abs(number) % 100 * 60)
    return F.coalesce(F.try_element_at(names, F.trim(zone)), numeric.cast("bigint"), F.lit(0))


def parse_play_time(text: Column | str) -> Column:
    """Epoch seconds from free play-time text, or null when unparseable.

    Whitespace of any kind (NBSP, narrow NBSP before AM/PM) is collapsed and
    a leading weekday dropped; a trailing zone name (mapped to a fixed
    offset), or a ``Z`` or numeric offset after a time of day, is split off;
    the remaining wall time is tried against a list of patterns and read as
    UTC when no zone is given.
    """
    txt = F.regexp_replace(F.trim(F.regexp_replace(col_(text), r"(?U)\s+", " ")), _WEEKDAY, "")

    def wall(body: Column) -> Column:
        return F.coalesce(*[F.try_to_timestamp(body, F.lit(fmt)) for fmt in PLAY_TIME_FORMATS])

    def epoch(t: Column) -> Column:
        def of_zone(zone: Column) -> Column:
            body = F.left(t, F.length(t) - F.length(zone))  # a zone stands at the end
            return (F.unix_seconds(_once(body, wall)) - _zone_offset(zone)).cast("bigint")
        return _once(F.regexp_extract(t, _ZONE, 0), of_zone)

    return _once(txt, epoch)


def coerce_unix(unix_ts: Column | str, text: Column | str, numeric: bool = False) -> Column:
    """The play's epoch second.

    A usable ``unix_timestamp`` wins (null, '' and 0 fall through, as they
    are falsy); otherwise the text time is parsed.  A non-numeric
    ``unix_timestamp`` also falls through instead of failing.  ``numeric``
    says the column already holds numbers (no text round trip needed).
    """
    raw = col_(unix_ts)
    if numeric:
        return F.when(raw.isNotNull() & (raw != 0), raw.cast("bigint")).otherwise(parse_play_time(text))
    as_num = raw.cast("string").try_cast("double")
    usable = as_num.isNotNull() & (as_num != 0) & ~F.isnan(as_num)
    return F.when(usable, as_num.try_cast("bigint")).otherwise(parse_play_time(text))


def played_at(epoch: Column | str) -> Column:
    """Epoch seconds -> wall-clock timestamp (UTC, no zone attached)."""
    return F.timestamp_seconds(col_(epoch)).cast("timestamp_ntz")


def day_start(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def day_of_week(ts: Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def time_of_day(hour: Column) -> Column:
    expr = None
    for label, lo, hi in TIME_OF_DAY_BUCKETS:
        cond = hour.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(NIGHT))


def date_text(ts: Column | str) -> Column:
    """``CAST(ts AS VARCHAR)[:10]`` -- the calendar date as yyyy-MM-dd."""
    return F.date_format(col_(ts), "yyyy-MM-dd")
