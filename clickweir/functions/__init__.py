"""Column -> Column functions; every one is a built-in Spark expression."""

from clickweir.functions.calendar import day_of_week, event_date, event_hour, minute_bucket, wall_clock
from clickweir.functions.category import category_level, category_levels, clean_category_code
from clickweir.functions.coerce import parse_event_time, parse_long, parse_price

__all__ = [
    "category_level",
    "category_levels",
    "clean_category_code",
    "day_of_week",
    "event_date",
    "event_hour",
    "minute_bucket",
    "parse_event_time",
    "parse_long",
    "parse_price",
    "wall_clock",
]
