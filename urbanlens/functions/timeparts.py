"""Time functions on TIMESTAMP_NTZ (local wall-clock) columns.

Everything here is a built-in column expression, so it stays inside whole-stage
codegen. Truncation is done with exact microsecond arithmetic against the epoch
instead of ``date_trunc`` (which returns a session-zone TIMESTAMP), so results
do not depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE
MICROS_PER_DAY = 24 * MICROS_PER_HOUR
MICROS_PER_WEEK = 7 * MICROS_PER_DAY

# Business hours of the reference: 09:00 to 17:00, Monday to Friday, no holidays.
BH_OPEN_S = 9 * 3600
BH_CLOSE_S = 17 * 3600


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp, from its date
    and clock fields. (``timestamp_diff`` on TIMESTAMP_NTZ goes through the
    session zone and is an hour off for wall times inside a DST gap.)"""
    t = _c(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    secs = (F.date_part(F.lit("SECOND"), t) * F.lit(MICROS_PER_SECOND)).cast("bigint")
    return (days * F.lit(MICROS_PER_DAY) + F.hour(t).cast("bigint") * F.lit(MICROS_PER_HOUR)
            + F.minute(t).cast("bigint") * F.lit(MICROS_PER_MINUTE) + secs)


def from_epoch_micros(us) -> Column:
    return F.timestamp_add("MICROSECOND", _c(us), epoch_ntz())


def floor_ntz(ts, micros: int) -> Column:
    """Floor a TIMESTAMP_NTZ to a multiple of ``micros`` since the epoch."""
    us = epoch_micros(ts)
    return from_epoch_micros(us - F.pmod(us, F.lit(micros)))


def trunc_second(ts) -> Column:
    return floor_ntz(ts, MICROS_PER_SECOND)


def trunc_minute(ts) -> Column:
    return floor_ntz(ts, MICROS_PER_MINUTE)


def trunc_hour(ts) -> Column:
    return floor_ntz(ts, MICROS_PER_HOUR)


def trunc_day(ts) -> Column:
    return floor_ntz(ts, MICROS_PER_DAY)


def trunc_week_epoch(ts) -> Column:
    """numpy ``M8[W]`` week: weeks counted from 1970-01-01, a Thursday."""
    return floor_ntz(ts, MICROS_PER_WEEK)


def bin_minutes(ts, minutes: int = 6) -> Column:
    """Floor to an n-minute bin (``6*floor(minute/6)`` within the hour for n | 60)."""
    return floor_ntz(ts, minutes * MICROS_PER_MINUTE)


def local_to_utc(ts, tz: str = "America/New_York") -> Column:
    """Wall time in ``tz`` to UTC wall time, staying TIMESTAMP_NTZ.

    Spring-gap times move forward by the gap; autumn-overlap times take the
    first (daylight) offset, as ``to_utc_timestamp`` does.
    """
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(ts))


def epoch_micros_to_ts(us) -> Column:
    """int64 epoch microseconds to a wall-clock timestamp truncated to seconds."""
    return from_epoch_micros(F.floor(_c(us) / F.lit(MICROS_PER_SECOND)) * F.lit(MICROS_PER_SECOND))


def seconds_of_day(ts) -> Column:
    return (epoch_micros(ts) - epoch_micros(trunc_day(ts))) / F.lit(float(MICROS_PER_SECOND))


def is_business_day(ts) -> Column:
    return F.weekday(_c(ts)) < 5


# English weekday and month names (Monday = 0, January = 1).
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def weekday_name(ts) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(_c(ts)) + 1)


_TOKENS = [("yyyy", "%04d", lambda t: F.year(t)), ("yy", "%02d", lambda t: F.year(t) % 100),
           ("MM", "%02d", lambda t: F.month(t)), ("dd", "%02d", lambda t: F.dayofmonth(t)),
           ("HH", "%02d", lambda t: F.hour(t)), ("mm", "%02d", lambda t: F.minute(t)),
           ("ss", "%02d", lambda t: F.second(t))]


def format_ntz(ts, pattern: str) -> Column:
    """``date_format`` for TIMESTAMP_NTZ without the session zone.

    Supports ``yyyy yy MM dd HH mm ss`` and literal text; the fields come
    from ``year``/``hour``/... which read the wall clock directly (Spark's
    ``date_format`` converts through the session zone and shifts wall times
    that fall in a DST gap)."""
    t = _c(ts)
    spec, args, i = "", [], 0
    while i < len(pattern):
        for tok, fmt, fn in _TOKENS:
            if pattern.startswith(tok, i):
                spec += fmt
                args.append(fn(t))
                i += len(tok)
                break
        else:
            ch = pattern[i]
            spec += "%%" if ch == "%" else ch
            i += 1
    return F.when(t.isNotNull(), F.format_string(spec, *args))


def iso_week(ts) -> Column:
    return F.weekofyear(_c(ts))


def frac_of_year(ts) -> Column:
    t = _c(ts)
    return (F.dayofyear(t) / F.lit(365.0) + F.hour(t) / F.lit(24.0) / F.lit(365.0)
            + F.minute(t) / F.lit(60.0) / F.lit(24.0) / F.lit(365.0))


def frac_of_day(ts) -> Column:
    t = _c(ts)
    return F.hour(t) / F.lit(24.0) + F.minute(t) / F.lit(60.0) / F.lit(24.0)


def frac_of_hour(ts) -> Column:
    return F.minute(_c(ts)) / F.lit(60.0)


def position_in_week(ts) -> Column:
    """Monday=0 day index plus the fraction of the day (hour and minute)."""
    t = _c(ts)
    return F.weekday(t) + F.hour(t) / F.lit(24.0) + F.minute(t) / F.lit(60.0) / F.lit(24.0)


def _days(ts, n) -> Column:
    return F.timestamp_add("DAY", n, ts)


def _next_bday_midnight(t: Column) -> Column:
    wd = F.weekday(t)
    step = F.when(wd == 4, 3).when(wd == 5, 2).otherwise(1)
    return _days(trunc_day(t), step)


def _prev_bday_midnight(t: Column) -> Column:
    wd = F.weekday(t)
    step = F.when(wd == 0, -3).when(wd == 6, -2).otherwise(-1)
    return _days(trunc_day(t), step)


def add_business_hour(ts) -> Column:
    """``t + BusinessHour(1)`` for a 09:00-17:00 Monday-Friday calendar."""
    t = _c(ts)
    wd = F.weekday(t)
    s = seconds_of_day(t)
    d0 = trunc_day(t)
    nb = _next_bday_midnight(t)
    open_plus_1 = BH_OPEN_S + 3600
    rem_us = ((s - F.lit(BH_CLOSE_S - 3600)) * F.lit(MICROS_PER_SECOND)).cast("bigint")
    return (F.when((wd < 5) & (s < BH_OPEN_S), F.timestamp_add("SECOND", F.lit(open_plus_1), d0))
            .when((wd < 5) & (s < BH_CLOSE_S - 3600), F.timestamp_add("HOUR", F.lit(1), t))
            .when((wd < 5) & (s < BH_CLOSE_S),
                  F.timestamp_add("MICROSECOND", rem_us, F.timestamp_add("SECOND", F.lit(BH_OPEN_S), nb)))
            .otherwise(F.timestamp_add("SECOND", F.lit(open_plus_1), nb)))


def subtract_business_hour(ts) -> Column:
    """``t + BusinessHour(-1)`` for a 09:00-17:00 Monday-Friday calendar."""
    t = _c(ts)
    wd = F.weekday(t)
    s = seconds_of_day(t)
    d0 = trunc_day(t)
    pb = _prev_bday_midnight(t)
    close_minus_1 = BH_CLOSE_S - 3600
    back_us = ((F.lit(BH_OPEN_S + 3600) - s) * F.lit(MICROS_PER_SECOND)).cast("bigint")
    return (F.when((wd < 5) & (s > BH_CLOSE_S), F.timestamp_add("SECOND", F.lit(close_minus_1), d0))
            .when((wd < 5) & (s > BH_OPEN_S + 3600), F.timestamp_add("HOUR", F.lit(-1), t))
            .when((wd < 5) & (s > BH_OPEN_S),
                  F.timestamp_add("MICROSECOND", -back_us, F.timestamp_add("SECOND", F.lit(BH_CLOSE_S), pb)))
            .otherwise(F.timestamp_add("SECOND", F.lit(close_minus_1), pb)))


def _hours_between(a: Column, b: Column) -> Column:
    return (epoch_micros(b) - epoch_micros(a)) / F.lit(float(MICROS_PER_HOUR))


def business_hour_fwd(ts) -> Column:
    """Hours from ``t`` to the next business hour: ``((t+BH(1))-t-3600s)/3600``."""
    t = _c(ts)
    return _hours_between(t, add_business_hour(t)) - F.lit(1.0)


def business_hour_back(ts, plus_one: bool = False) -> Column:
    """``((t+BH(-1))-t)/3600``; ``plus_one`` gives the ``+3600`` variant."""
    t = _c(ts)
    h = _hours_between(t, subtract_business_hour(t))
    return h + F.lit(1.0) if plus_one else h


def six_minute_label(ts) -> Column:
    """``yyyy-MM-dd HH:mm:00`` label of the 6-minute bin (24-hour clock).

    The reference formats with ``hh`` (12-hour), which merges AM and PM; the
    label here uses ``HH`` so it lines up with a 24-hour calendar.
    """
    t = _c(ts)
    return F.concat(format_ntz(t, "yyyy-MM-dd HH:"),
                    F.format_string("%02d:00", (F.floor(F.minute(t) / F.lit(6.0)) * 6).cast("int")))


def parse_datetime_flexible(text, formats=("MM/dd/yyyy HH:mm:ss", "MM-dd-yy HH:mm:ss")) -> Column:
    """First format that parses wins; unparseable text gives null (never throws)."""
    s = _c(text)
    return F.coalesce(*[_try_parse_ntz(s, f) for f in formats])


# Seconds and a fraction of up to six digits are optional in every layout.
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d{1,6})?)?\s*$"
_FORMAT_PATTERNS = {
    "MM/dd/yyyy HH:mm:ss": r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s+" + _CLOCK,
    "MM-dd-yy HH:mm:ss": r"^\s*(\d{1,2})-(\d{1,2})-(\d{2})\s+" + _CLOCK,
    "yyyy-MM-dd HH:mm:ss": r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})[ T]" + _CLOCK,
}


def unparsed(text, parsed) -> Column:
    """Whether a non-blank text gave no time: count or keep such rows beside the result."""
    return (F.trim(_c(text)) != "") & _c(parsed).isNull()


def _try_parse_ntz(s: Column, fmt: str) -> Column:
    """Validate the layout with one regex, split once into the numbers, then
    ``try_make_timestamp_ntz`` (null for impossible dates)."""
    pat = _FORMAT_PATTERNS[fmt]
    p = F.split(F.trim(s), r"[-/:T ]+")

    def g(i):
        return p[i].try_cast("int")

    if fmt.startswith("yyyy"):
        y, mo, d = g(0), g(1), g(2)
    else:
        mo, d, y = g(0), g(1), g(2)
    if fmt.startswith("MM-dd-yy "):
        y = y + F.lit(2000)
    sec = F.coalesce(F.get(p, F.lit(5)).try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)"))
    return F.when(s.rlike(pat), F.try_make_timestamp_ntz(y, mo, d, g(3), g(4), sec))


def parse_date_compact(text) -> Column:
    """``yyyyMMdd`` text to DATE; bad text gives null."""
    return F.try_to_date(_c(text), "yyyyMMdd")


def parse_long_date(text) -> Column:
    """``Saturday, April 22, 2017`` to DATE. The weekday is dropped before
    parsing because ``EEEE`` is not accepted by the parser."""
    s = F.regexp_replace(_c(text), r"^\s*[A-Za-z]+,\s*", "")
    return F.try_to_date(s, "MMMM d, yyyy")
