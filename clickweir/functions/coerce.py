"""Tolerant parsing of raw text columns: a bad value becomes null.

ANSI mode is on in Spark 4, so a plain ``cast`` of bad text fails the
job; these use ``try_cast`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweir.schema import PRICE_TYPE

# Text without a zone: a date, or a date and a time of day.
_LOCAL = r"^[+-]?\d{4,6}(-\d{1,2}(-\d{1,2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?)?)?$"
# Text with one: after the time of day comes a name (UTC, Z, EST,
# Europe/Paris) or a numeric offset. A date alone has no zone: the sign in
# ``2019-10-01`` starts no offset.
_ZONED = r"\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?\s*([A-Za-z][\w+\-/]*|[+-]\d{1,2}(:?\d{2}(:\d{2})?)?)$"
_SHORT_OFFSET = r"([+-]\d{2})(\d{2})$"

_EPOCH = "1970-01-01 00:00:00"

# Whole numbers, written plainly and with an exponent.
_PLAIN = r"^[+-]?(\d+\.?0*|\.0+)$"
_EXPONENT = r"^[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d{1,3}$"
# Digits a double holds exactly, and the bound of exact whole doubles.
_EXACT_DIGITS = 15
_EXACT_LIMIT = float(2**53)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(c: Column | str) -> Column:
    """Text -> TIMESTAMP_NTZ holding the UTC wall clock; bad text -> null.

    Text with a zone, an offset or a name, is converted to UTC and the zone
    dropped (an unknown name gives null); text without one is taken as UTC
    already. Neither path depends on the session time zone.
    """
    s = F.trim(_col(c))
    instant = F.regexp_replace(s, _SHORT_OFFSET, "$1:$2").try_cast("timestamp")
    utc_wall = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit(_EPOCH).cast("timestamp_ntz"))
    return F.when(s.rlike(_LOCAL), s.try_cast("timestamp_ntz")).when(s.rlike(_ZONED), utc_wall)


def parse_long(c: Column | str) -> Column:
    """Text -> bigint; bad or fractional text -> null, never a rounded
    number. ``'12.0'`` and ``'1.2e1'`` parse as 12, ``'12.0000001'`` as null.
    With an exponent, up to 15 digits are taken (a double holds them exactly)."""
    s = F.trim(_col(c))
    whole = F.regexp_replace(F.regexp_replace(s, r"\.0*$", ""), r"^([+-]?)$", "$10")
    d = s.try_cast("double")
    digits = F.length(F.regexp_replace(F.regexp_replace(s, "[eE].*$", ""), r"\D", ""))
    exact = s.rlike(_EXPONENT) & (digits <= _EXACT_DIGITS) & (d == F.floor(d)) & (F.abs(d) < _EXACT_LIMIT)
    return F.when(s.rlike(_PLAIN), whole.try_cast("bigint")).when(exact, d.try_cast("bigint"))


def parse_price(c: Column | str) -> Column:
    """Text -> decimal(14,2), rounded half-up; ``nan`` and bad text -> null."""
    return F.trim(_col(c)).try_cast(PRICE_TYPE)
