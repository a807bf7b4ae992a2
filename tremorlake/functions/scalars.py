"""Scalar expressions over typed columns. All of them are safe under ANSI mode:
a value that does not convert becomes null instead of failing the query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that introduces the area in a place name, and the
# pattern and formats results must follow.
AREA_PATTERN = r"of (.+)$"
AREA_SEPARATOR = " of "
_SECONDS_LENGTH = len("2024-01-30T12:00:00")
_MICROS_LENGTH = len("2024-01-30T12:00:00.000000")
# Years 1 to 9999, the range a calendar time can take.
FIRST_EPOCH_MS = -62_135_596_800_000
LAST_EPOCH_MS = 253_402_300_799_999


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _utc_clock(units: Column, digits: int) -> Column:
    """The UTC wall clock, without a zone, of an epoch in units of 10 ** -digits seconds."""
    seconds = (units.cast("decimal(18,0)") / F.lit(10**digits).cast("decimal(7,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(zero, zero, zero, seconds)


def epoch_ms_to_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds (number or text) to a timestamp in whole seconds.

    Fractions are cut toward zero, so -1500 ms is one second before the epoch.
    """
    seconds = (_column(ms).try_cast("double") / F.lit(1000)).try_cast("bigint")
    return seconds.try_cast("timestamp")


def epoch_ms_to_iso(ms: Column | str) -> Column:
    """Epoch milliseconds to UTC ISO text, with six digits of fraction or none.

    The zone of the session does not matter.
    """
    value = _column(ms).try_cast("bigint")
    shown = _utc_clock(F.when(value.between(FIRST_EPOCH_MS, LAST_EPOCH_MS), value), 3).cast("string")
    digits = F.when(F.length(shown) > _SECONDS_LENGTH, _MICROS_LENGTH).otherwise(_SECONDS_LENGTH)
    return F.rpad(F.replace(shown, F.lit(" "), F.lit("T")), digits, F.lit("0"))


def area_regex(place: Column | str) -> Column:
    """Text after the first `of ` up to the end; empty without one, null for null."""
    return F.regexp_extract(_column(place), AREA_PATTERN, 1)


def area_split(place: Column | str) -> Column:
    """Second piece of the place split on ` of `; empty when there is none."""
    second = F.split_part(_column(place), F.lit(AREA_SEPARATOR), F.lit(2))
    return F.coalesce(second, F.lit(""))


def load_clock(as_of: dt.datetime | None = None) -> Column:
    """The load timestamp: one value for the whole query, or a given instant.

    A given instant without a zone counts as UTC.
    """
    if as_of is None:
        return F.current_timestamp()
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(round(as_of.timestamp() * 1_000_000)))


def record_clock_iso(as_of: dt.datetime | None = None) -> Column:
    """The load timestamp as UTC ISO text.

    It is constant within a query, so a retried task writes the same value, and
    the zone of the session does not matter.
    """
    shown = _utc_clock(F.unix_micros(load_clock(as_of)), 6).cast("string")
    whole = F.when(F.length(shown) > _SECONDS_LENGTH, shown).otherwise(F.concat(shown, F.lit(".")))
    return F.rpad(F.replace(whole, F.lit(" "), F.lit("T")), _MICROS_LENGTH, F.lit("0"))


def days_before(as_of: dt.date | None, days: int) -> Column:
    """The date `days` before the given date (today when there is none)."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return F.date_sub(day, days)
