"""Category-path column functions (Column -> Column, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The null literal the source writes as text, and the path
# separator (a regex, so the dot is escaped).
NULL_TEXT = "nan"
LEVEL_SEPARATOR = r"\."
LEVELS = 3


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_category_code(c: Column | str) -> Column:
    """``'nan'`` in any case, padded by spaces only, becomes null.

    Any other value comes back unchanged (untrimmed); null stays null
    because a null condition falls through to ``otherwise``.
    """
    c = _col(c)
    return F.when(F.lower(F.trim(c)) == F.lit(NULL_TEXT), F.lit(None).cast("string")).otherwise(c)


def category_level(c: Column | str, level: int) -> Column:
    """The 1-based ``level`` of a dotted path; null when the path is shorter.

    ``get`` (not ``[]``/``element_at``) so an out-of-range index is null
    even with ANSI mode on.
    """
    return F.get(F.split(_col(c), LEVEL_SEPARATOR), level - 1)


def category_levels(c: Column | str, levels: int = LEVELS) -> list[Column]:
    return [category_level(c, i).alias(f"category_level_{i}") for i in range(1, levels + 1)]
