"""Time functions. Wall-clock times are ``timestamp_ntz``, instants ``timestamp``.

Crossing from one to the other always names a zone. Spark computes some of
these through the session zone, so run sessions in UTC (`tidelog.session` does):
a zone with daylight saving has wall-clock times that don't exist.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def to_millis(col: Column | str) -> Column:
    """Wall-clock time cut to milliseconds (Spark keeps microseconds)."""
    return F.date_trunc("millisecond", _col(col)).cast("timestamp_ntz")


def epoch_millis(wall: Column | str) -> Column:
    """Milliseconds since 1970 of a wall-clock time read as UTC."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), _col(wall))


def millis_to_ntz(millis: Column | str, zone: str = "UTC") -> Column:
    """Epoch milliseconds to the wall-clock time shown in ``zone``."""
    return _shift(F.timestamp_add("MILLISECOND", _col(millis), F.expr(_EPOCH)), zone)


def wall_clock(at: Column | str, zone: str = "UTC") -> Column:
    """Instant to the wall-clock time shown in ``zone``."""
    return _shift(
        F.timestamp_add("MICROSECOND", F.unix_micros(_col(at)), F.expr(_EPOCH)), zone
    )


def instant(wall: Column | str) -> Column:
    """UTC wall-clock time to an instant; watermarks accept only instants."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _col(wall)))


def window_time(window: Column | str = "window") -> Column:
    """Last millisecond that belongs to a window."""
    return _col(window)["end"] - F.expr("interval 1 millisecond")


def date_parts(wall: Column | str) -> tuple[Column, Column, Column]:
    """``dt``, ``hour`` and ``minute`` as text, in the layout of the files."""
    wall = _col(wall)
    return (
        F.date_format(wall, "yyyy-MM-dd").alias("dt"),
        F.date_format(wall, "HH").alias("hour"),
        F.date_format(wall, "mm").alias("minute"),
    )


def _shift(utc_wall: Column, zone: str) -> Column:
    if zone == "UTC":
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
