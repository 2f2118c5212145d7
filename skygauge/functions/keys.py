"""Hash keys and date keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skygauge.lookups import SURROGATE_NULL


def timestamp_text(ts: Column | str, millis: bool = True) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.SSS]`` of a zone-less timestamp, whatever the session zone.

    The stored keys hash the text with three fraction digits.
    """
    text = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz").cast("string")
    seconds = F.substring(text, 1, 19)
    if not millis:
        return seconds
    return F.concat(seconds, F.lit("."), F.rpad(F.substring(text, 21, 3), 3, "0"))


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts joined by '-', a fixed token standing for NULL."""
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(SURROGATE_NULL)) for p in parts]))


def date_key(day: Column | str) -> Column:
    """Integer yyyyMMdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
