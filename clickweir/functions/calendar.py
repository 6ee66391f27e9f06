"""Calendar fields of an event timestamp (Column -> Column).

All of them read the wall clock of the value: for TIMESTAMP_NTZ input
they do not depend on the session time zone; for zoned TIMESTAMP input
they use the session zone (the jobs run with UTC).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_date(c: Column | str) -> Column:
    return F.to_date(_col(c))


def event_hour(c: Column | str) -> Column:
    """Hour 0-23 as int."""
    return F.hour(_col(c))


def day_of_week(c: Column | str) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_col(c))


def minute_bucket(c: Column | str) -> Column:
    """The timestamp truncated to its minute, as TIMESTAMP_NTZ.

    Built from the wall-clock fields instead of ``date_trunc`` so the key
    keeps the NTZ type and never passes through the session zone.
    """
    c = _col(c)
    return F.make_timestamp_ntz(
        F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), F.lit(0)
    )


def wall_clock(c: Column | str) -> Column:
    """A timestamp as TIMESTAMP_NTZ (a zoned value becomes its wall clock in
    the session zone; NTZ stays as it is).

    Marks are collected through this, so the value the driver holds never
    depends on the Python process's own time zone.
    """
    return _col(c).cast("timestamp_ntz")
