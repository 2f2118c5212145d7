"""Timestamps: literals, parts, epochs, buckets and zone handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value) -> Column:
    """A zone-less timestamp literal from a datetime or its text."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def from_parts(year, month, day, hour) -> Column:
    """Zone-less timestamp of date parts; NULL where the parts make no valid time."""
    return F.try_make_timestamp_ntz(_col(year), _col(month), _col(day), _col(hour), F.lit(0), F.lit(0))


def from_parts_text(year, month, day, hour) -> Column:
    """The same through padded text, for parts that arrive as text."""
    pad = lambda c, n: F.lpad(_col(c).cast("string"), n, "0")
    text = F.concat(pad(year, 4), F.lit("-"), pad(month, 2), F.lit("-"), pad(day, 2),
                    F.lit(" "), pad(hour, 2), F.lit(":00:00"))
    return text.try_cast("timestamp_ntz")


def utc_instant(ntz: Column | str) -> Column:
    """Zone-less UTC time as an instant, independent of the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), _col(ntz)).cast("timestamp")


def utc_wall_clock(instant: Column | str) -> Column:
    """Instant as zone-less UTC time, independent of the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _col(instant).cast("timestamp_ntz"))


def is_instant(df: DataFrame, column: str) -> bool:
    return dict(df.dtypes)[column] == "timestamp"


def utc_day(value: Column, instant: bool) -> Column:
    """Day of a time: of an instant its day in UTC, so that it does not depend on the session zone."""
    return F.to_date(utc_wall_clock(value) if instant else value)


def from_epoch(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_col(seconds))


def to_epoch(instant: Column | str) -> Column:
    return F.unix_seconds(_col(instant))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Fractional seconds from ``earlier`` to ``later``, both of one timestamp type."""
    later, earlier = _col(later), _col(earlier)
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return micros / F.lit(1e6)


def bucket(ts: Column | str, width: str) -> Column:
    """Start of the epoch-aligned bucket of ``ts``."""
    return F.window(_col(ts), width).getField("start")


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(ts)
