"""Calendar helpers: date parts, day truncation, date codes, month lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnOrName, _col


def day_of(ts: ColumnOrName) -> Column:
    """Timestamp truncated to its calendar day, as a DATE."""
    return F.to_date(_col(ts))


def date_code(ts: ColumnOrName) -> Column:
    """``YYYY-MM-DD`` text of a timestamp, month and day zero-padded."""
    return F.date_format(_col(ts), "yyyy-MM-dd")


def date_parts(ts: ColumnOrName) -> list[Column]:
    """Day, month and year of a timestamp as ints named like the Dates dimension."""
    c = _col(ts)
    return [
        F.dayofmonth(c).alias("Day_Num"),
        F.month(c).alias("Month_Num"),
        F.year(c).alias("Year"),
    ]


def days_in_month(year: ColumnOrName, month: ColumnOrName) -> Column:
    """Number of days of the month (leap-year aware)."""
    return F.dayofmonth(F.last_day(F.make_date(_col(year), _col(month), F.lit(1))))


def year_text(ts: ColumnOrName) -> Column:
    """Year of a timestamp as text, as the source-side reports label years."""
    return F.year(_col(ts)).cast("string")
