"""Dates, times and durations."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselabel import vocab

# The statistics package counts seconds from this day.
_SPSS_EPOCH = dt.datetime(1582, 10, 14, tzinfo=dt.timezone.utc)
_SPSS_OFFSET = -int(_SPSS_EPOCH.timestamp())

_UNITS = {"W": 604800, "D": 86400, "H": 3600, "M": 60, "S": 1}


def _pick(names: tuple[str, ...], position: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))


def _in_range(value: Column, low: int, high: int) -> Column:
    return F.when(value.between(low, high), value)


def month_short(month: Column) -> Column:
    """Short Spanish month name; NULL for a month outside 1..12."""
    return _pick(vocab.MONTHS_SHORT, _in_range(month, 1, 12))


def month_full(month: Column) -> Column:
    """Full Spanish month name; NULL for a month outside 1..12."""
    return _pick(vocab.MONTHS_FULL, _in_range(month, 1, 12))


def parse_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Timestamp of a text in the given format; NULL when it does not fit."""
    return F.try_to_timestamp(text, F.lit(fmt))


def weekday_name(date: Column) -> Column:
    """Spanish weekday name."""
    return _pick(vocab.WEEKDAYS, F.weekday(date) + 1)


def from_spss(seconds: Column) -> Column:
    """Timestamp of an SPSS date, counted in seconds since 1582-10-14."""
    return F.timestamp_seconds(seconds - _SPSS_OFFSET)


def hour_band(time: Column) -> Column:
    """Six-hour band of a time of day; ``S.D.`` when the text is not one.

    ``7:05``, ``07:05:59`` and fractions of a second are times, so no moment of
    the day falls between two bands.
    """
    shaped = time.rlike(r"^\s*([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]*)?)?\s*$")
    hour = F.when(shaped, F.regexp_extract(time, r"^\s*([0-9]+):", 1).try_cast("int"))
    return (
        F.when(hour < 6, "00:00 - 05:59")
        .when(hour < 12, "06:00 - 11:59")
        .when(hour < 18, "12:00 - 17:59")
        .when(hour < 24, "18:00 - 23:59")
        .otherwise("S.D.")
    )


def duration_text(value: Column, layout: str = "{D:02}d {H:02}h {M:02}m {S:02}s", unit: str = "s") -> Column:
    """Write a duration with the units named in ``layout`` (W, D, H, M, S).

    ``value`` counts units of ``unit``: s, m, h, d or w, in any case; a fraction
    is kept to the second.  The largest unit present takes all that is left, as
    in ``{H}h {S}s`` giving ``30h 90s``.  A width may follow the unit: ``{D:2}``
    or ``{M:02}``.
    """
    if unit.upper() not in _UNITS:
        raise ValueError(f"unit {unit!r} is not one of s, m, h, d, w")
    seconds = value * _UNITS[unit.upper()]
    rest = seconds.cast("bigint")
    wanted = set(re.findall(r"\{([WDHMS])", layout))
    values = {}
    for unit, size in _UNITS.items():
        if unit in wanted:
            part = F.floor(rest / size).cast("bigint") if size > 1 else rest
            values[unit] = part
            rest = F.pmod(rest, F.lit(size).cast("bigint"))
    fields = re.findall(r"\{([WDHMS])(?::(\d+))?\}", layout)
    pattern = re.sub(r"\{[WDHMS](?::(\d+))?\}", lambda m: f"%{m.group(1) or ''}d", layout)
    return F.when(seconds.isNotNull(), F.format_string(pattern, *[values[u] for u, _ in fields]))
