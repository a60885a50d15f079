"""Calendar expressions for the date dimension and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names that make a day a weekend (reference semantics).
WEEKEND_DAYS = ("Saturday", "Sunday")


def date_key(d) -> Column:
    """YYYYMMDD as an int (``STRFTIME(d, '%Y%m%d')`` cast to INTEGER); NULL stays NULL."""
    d = F.col(d) if isinstance(d, str) else d
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def weekday_name(d) -> Column:
    """Full English weekday name (``%A``)."""
    d = F.col(d) if isinstance(d, str) else d
    return F.date_format(d, "EEEE")


def is_weekend(d) -> Column:
    return weekday_name(d).isin(*WEEKEND_DAYS)


def iso_week(d) -> Column:
    """ISO-8601 week number, as ``EXTRACT(WEEK ...)``."""
    d = F.col(d) if isinstance(d, str) else d
    return F.weekofyear(d).cast("int")


def parse_date(c, formats=("dd/MM/yyyy", "dd/MM/yy", "yyyy-MM-dd")) -> Column:
    """Text → DATE trying each format in turn; unparseable text becomes NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])
