"""Time text, epochs, day numbers and packed times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import whole_div

# Fixed values
SOURCE_OFFSET_HOURS = 8          # commit times are written in UTC+8
MAX_TIME_HOURS = 838             # largest hour of a TIME value
MAX_ZONE_HOURS = 14              # largest zone offset
MAX_EPOCH_SECOND = 32536771199   # last second a TIMESTAMP may hold
EPOCH_DAY_NUMBER = 719528        # day number of 1970-01-01 counted from year 0

_COMMIT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d{1,6})?"
# TIME text, each rewritten to "sign,days,hours,minutes,seconds,fraction"
_TIME_FORMS = [
    (r"^\s*(-?)(\d+)\s+(?=\d.)(\d+)(?::(\d+))?(?::(\d+))?(?:\.(\d{0,6}))?.*$", "$1,$2,$3,$4,$5,$6"),
    (r"^\s*(-?)(\d+):(\d+)(?::(\d+))?(?:\.(\d{0,6}))?[^,]*$", "$1,0,$2,$3,$4,$5"),
    (r"^\s*(-?)(\d*?)(\d{0,2}?)(\d{1,2})(?:\.(\d{0,6})[^,]*|[^\d,][^,]*)?$", "$1,0,$2,$3,$4,$5"),
    (r"^[^,]*$", ""),
]
_PLAIN_STAMP = r"^\d{4}-\d{2}-\d{2}(?: \d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)?$"   # nothing to rewrite
# date-time text, each rewritten to "year-month-day hour:minute:second.fraction"
_STAMP = "$1-$2-$3 $4:$5:$6.$7"
_STAMP_FORMS = [
    (r"^\s*(\d{4})(\d{2})(\d{2})(?:T?(\d{2})(\d{2})(\d{2})\d*(?:\.(\d{0,6})\d*)?)?$", _STAMP),
    (r"^\s*(\d{2})(\d{2})(\d{1,2})(?:(\d{2})(?:(\d{2})(\d{1,2})?)?)?(?:\.(\d{0,6})\d*)?$", _STAMP),
    (r"^\s*(\d+)[\p{Punct}\s]+(\d+)[\p{Punct}\s]+(\d+)"
     r"(?:(?:T|[\p{Punct}\s]+)(\d+)(?:[\p{Punct}\s]+(\d+)(?:[\p{Punct}\s]+(\d+)(?:\.(\d{0,6}))?)?)?)?.*$", _STAMP),
    (r"[ :.]+$", ""),
    (r"^([0-6]\d)-", "20$1-"),
    (r"^([7-9]\d)-", "19$1-"),
    (r"^(?!\d{4}-\d{1,2}-\d{1,2}( |$)).*$", ""),
]
_ZONE = r"^([+-])(\d{2}):(\d{2})\s*$"


NO_CLOCK = "null:null:null.  null"
"""What ``commit_text`` says without a time; ``commit_micros`` refuses it."""


def _number(c: Column) -> Column:
    """Digits to bigint; an empty or missing group counts as 0."""
    return F.coalesce(c.try_cast("long"), F.lit(0).cast("long"))


def _fraction(c: Column) -> Column:
    """1 to 6 fraction digits as microseconds."""
    return _number(F.rpad(F.coalesce(c, F.lit("")), 6, "0"))


def _rewrite(text: Column, forms: list[tuple[str, str]]) -> Column:
    """Bring the accepted spellings of a text into one, a form at a time (each leaves other texts alone)."""
    for pattern, shape in forms:
        text = F.regexp_replace(text, pattern, shape)
    return text


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def commit_micros(text: Column, offset_hours: int = SOURCE_OFFSET_HOURS) -> Column:
    """``YYYY-MM-DD HH:MM:SS[.f{1,6}]`` at a fixed offset → epoch microseconds; NULL if malformed."""
    local = F.regexp_extract(text, _COMMIT, 0).try_cast("timestamp_ntz")
    return ntz_micros(local) - offset_hours * 3_600_000_000


def commit_text(micros: Column, offset_hours: int = SOURCE_OFFSET_HOURS) -> Column:
    """Epoch microseconds → commit time text at a fixed offset (inverse of ``commit_micros``)."""
    local = micros + offset_hours * 3_600_000_000
    rest = F.pmod(local, F.lit(86_400_000_000))
    day = F.date_from_unix_date(whole_div(local - rest, 86_400_000_000).cast("int"))

    def digits(value: Column, n: int) -> Column:
        return F.lpad(value.cast("string"), n, "0")

    clock = F.concat(
        digits(whole_div(rest, 3_600_000_000), 2), F.lit(":"), digits(whole_div(rest, 60_000_000) % 60, 2), F.lit(":"),
        digits(whole_div(rest, 1_000_000) % 60, 2), F.lit("."), digits(rest % 1_000_000, 6))
    return F.concat_ws(" ", day.cast("string"), F.coalesce(clock, F.lit(NO_CLOCK)))


def time_micros(text: Column) -> Column:
    """TIME text → signed microseconds.

    Takes ``[-]D HH[:MM[:SS]]``, ``[-]HH:MM[:SS]`` and ``[-]HHMMSS`` (or a shorter number), each with a
    fraction cut to 6 digits. NULL when a part is out of range or nothing parses.
    """
    def total(parts: Column) -> Column:
        days, hours, minutes, seconds = (_number(F.get(parts, i)) for i in range(1, 5))
        h = days * 24 + hours
        size = ((h * 60 + minutes) * 60 + seconds) * 1_000_000 + _fraction(F.get(parts, 5))
        valid = (F.size(parts) == 6) & (h <= MAX_TIME_HOURS) & (minutes < 60) & (seconds < 60)
        return F.when(valid, F.when(F.get(parts, 0) == "-", -size).otherwise(size))

    return _once(F.split(_rewrite(text, _TIME_FORMS), ","), total)


def parse_time(text: Column) -> Column:
    """TIME text → day-time interval (hours may pass 24)."""
    return F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (time_micros(text).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)"))


def parse_datetime(text: Column) -> Column:
    """Date-time text → timestamp without zone.

    Parts may be split by any punctuation, white space or ``T``, or be run together as ``YYMMDD[HHMMSS]`` or
    ``YYYYMMDD[[T]HHMMSS]``. Two-digit years below 70 are 20xx, others 19xx. NULL for impossible dates.
    """
    return F.when(text.rlike(_PLAIN_STAMP), text.try_cast("timestamp_ntz")).otherwise(
        _rewrite(text, _STAMP_FORMS).try_cast("timestamp_ntz"))


def zone_offset_seconds(text: Column) -> Column:
    """``±HH:MM`` → seconds; minutes below 60, at most 14 hours, ``-00:00`` refused."""
    def total(zone: Column) -> Column:
        hours, minutes = (F.substring(zone, at, 2).cast("int") for at in (2, 5))
        size = (hours * 3600 + minutes * 60).cast("long")
        negative = F.substring(zone, 1, 1) == "-"
        valid = (minutes < 60) & (size <= MAX_ZONE_HOURS * 3600) & ~(negative & (size == 0))
        return F.when(valid, F.when(negative, -size).otherwise(size))

    return _once(F.nullif(F.regexp_extract(text, _ZONE, 0), F.lit("")), total)


def trailing_zone(text: Column) -> Column:
    """The zone offset at the end of a date-time text, or NULL."""
    return zone_offset_seconds(F.regexp_extract(text, r":\d{2}(?:\.\d+)?([+-]\d{2}:\d{2}\s*)$", 1))


def ntz_micros(ts: Column) -> Column:
    """Microseconds of a timestamp without zone counted from 1970-01-01 00:00:00 (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def local_epoch(ts: Column, zone: str | Column) -> Column:
    """Local date-time → epoch seconds; 0 outside what a TIMESTAMP may hold."""
    utc = F.to_utc_timestamp(ts.cast("timestamp"), zone)
    seconds = F.unix_seconds(utc)
    return F.when(ts.isNotNull(), F.when(seconds.between(0, MAX_EPOCH_SECOND), seconds).otherwise(0))


def day_number(day: Column) -> Column:
    """Days since year 0."""
    return F.unix_date(day.cast("date")) + EPOCH_DAY_NUMBER


def _packed(whole: Column, micros: Column) -> Column:
    return F.shiftleft(whole, 24) + micros


def pack_datetime(ts: Column) -> Column:
    """Date-time as one sortable bigint: year*13+month, day, hour, minute, second, microsecond."""
    months = (F.year(ts) * 13 + F.month(ts)).cast("long")
    ymd = F.shiftleft(months, 5) + F.dayofmonth(ts)
    hms = F.shiftleft(F.hour(ts).cast("long"), 12) + F.shiftleft(F.minute(ts).cast("long"), 6) + F.second(ts)
    micros = F.pmod(ntz_micros(ts), F.lit(1_000_000))
    return _packed(F.shiftleft(ymd, 17) + hms, micros)


def pack_time(micros: Column) -> Column:
    """Signed TIME microseconds as one sortable bigint: hour, minute, second, microsecond."""
    size = F.abs(micros)
    seconds = whole_div(size, 1_000_000)
    hms = F.shiftleft(whole_div(seconds, 3600), 12) + F.shiftleft(whole_div(seconds, 60) % 60, 6) + seconds % 60
    packed = _packed(hms, size % 1_000_000)
    return F.when(micros < 0, -packed).otherwise(packed)


def year_code(year: Column) -> Column:
    """YEAR as stored: distance from 2000 or from 1900."""
    return year - F.when(year >= 2000, 2000).otherwise(1900)


def fraction_bytes(digits: Column) -> Column:
    """Bytes that hold 0 to 6 fraction digits."""
    return whole_div(digits + 1, 2).cast("int")


def truncate_fraction(micros: Column, digits: Column) -> Column:
    """Cut microseconds to ``digits`` fraction digits."""
    unit = F.element_at(F.array(*[F.lit(10 ** (6 - d)).cast("long") for d in range(7)]), digits + 1)
    return micros - F.pmod(micros, unit)
