"""Origin-time functions as column expressions (timestamps without time zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970 of a zone-less timestamp."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(ts))


def from_micros(micros) -> Column:
    return F.timestamp_add("MICROSECOND", _c(micros), F.expr(_EPOCH))


def timestamp_parts(ts) -> dict[str, Column]:
    """Year, month, day, hour, minute and second with fraction."""
    ts = _c(ts)
    return {
        "yr": F.year(ts),
        "mo": F.month(ts),
        "dy": F.dayofmonth(ts),
        "hr": F.hour(ts),
        "mi": F.minute(ts),
        "sc": F.pmod(epoch_micros(ts), F.lit(60_000_000)) / F.lit(1e6),
    }


def parse_iso(text) -> Column:
    """ISO text, with or without a trailing Z, to a timestamp; unreadable text is NULL."""
    plain = F.regexp_replace(_c(text), r"(Z|[+-]00:?00)$", "")
    return plain.try_cast("timestamp_ntz")


def rounded_millis(seconds) -> Column:
    """Whole milliseconds of seconds from 0 on, rounded as C and Python print ``%.3f``.

    The exact binary value decides, and a value exactly half way goes to the even millisecond. Java's formats round the
    shortest decimal instead: 35.1185 is stored slightly below itself, so it gives 35118 here and 35.119 there.
    """
    s = _c(seconds).cast("double")
    low = F.floor(s * 1000.0)
    odd = (low * 2 + 1).cast("double")  # the half way point is odd / 2000
    half = odd / 2000.0
    # where the nearest double to the half way point is the value itself, its exact distance: products of 26 bits are exact
    wide = s * 134217729.0
    high = wide - (wide - s)
    beyond = (high * 2000.0 - odd) + (s - high) * 2000.0
    up = (s > half) | ((s == half) & ((beyond > 0) | ((beyond == 0) & (low % 2 == 1))))
    return low + F.when(up, F.lit(1)).otherwise(F.lit(0))


def parts_to_iso(yr, mo, dy, hr, mi, sc) -> Column:
    """ISO text with milliseconds; rounding may print the second as 60.000."""
    millis = rounded_millis(sc)
    whole, rest = F.floor(millis / 1000), millis % 1000
    return F.format_string("%04d-%02d-%02dT%02d:%02d:%02d.%03dZ", _c(yr), _c(mo), _c(dy), _c(hr), _c(mi), whole, rest)


def date_int(ts) -> Column:
    """Yyyymmdd."""
    ts = _c(ts)
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def time_int(ts) -> Column:
    """Hhmmsscc, hundredths cut as in the text files."""
    ts = _c(ts)
    hundredths = F.expr("0") + F.floor(F.pmod(epoch_micros(ts), F.lit(60_000_000)) / 10_000)
    return F.hour(ts) * 1_000_000 + F.minute(ts) * 10_000 + hundredths.cast("int")


def from_date_time_ints(date, time) -> Column:
    """Timestamp of yyyymmdd and hhmmsscc; hundredths above 5999 carry over."""
    date, time = _c(date).cast("bigint"), _c(time).cast("bigint")
    day = F.make_date(
        F.floor(date / 10_000).cast("int"),
        F.floor(date / 100 % 100).cast("int"),
        (date % 100).cast("int"),
    ).cast("timestamp_ntz")
    hours, minutes = F.floor(time / 1_000_000), F.floor(time / 10_000) % 100
    micros = (hours * 3600 + minutes * 60) * 1_000_000 + (time % 10_000) * 10_000
    return F.timestamp_add("MICROSECOND", micros, day)


def from_parts(yr, mo, dy, hr, mi, sc) -> Column:
    """Timestamp of separate parts; seconds of 60 and more carry over."""
    day = F.make_date(_c(yr), _c(mo), _c(dy)).cast("timestamp_ntz")
    micros = (_c(hr).cast("bigint") * 3600 + _c(mi).cast("bigint") * 60) * 1_000_000 + F.round(
        _c(sc) * 1e6
    ).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, day)


def shift_origin(ts, shift_s) -> Column:
    """T4: origin time minus a shift in seconds, carried through minutes and days."""
    return F.timestamp_add("MICROSECOND", -F.round(_c(shift_s) * 1e6).cast("bigint"), _c(ts))


def travel_time_over_hour(pick_min, pick_sec, origin_min, origin_sec) -> Column:
    """T5: pick minus origin when only minutes within the hour are known."""
    pick_min, origin_min = _c(pick_min), _c(origin_min)
    minutes = F.when(pick_min < origin_min, pick_min + 60 - origin_min).otherwise(pick_min - origin_min)
    return minutes * 60.0 + (_c(pick_sec) - _c(origin_sec))
