"""Numeric building blocks shared by measures, facts and KPIs.

Durations are carried as integer microseconds and summed as integers; a sum
is turned into hours, minutes or days by one final division.  That keeps
every sum independent of the order in which partitions are combined, so a
value hash of the result is stable across runs and engines.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed unit sizes, in microseconds.
MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Signed microseconds from ``start`` to ``end``; null if either is null."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def micros_to(unit_micros: int, micros: ColumnOrName) -> Column:
    """Integer microseconds as a double count of ``unit_micros`` units."""
    return _col(micros).cast("double") / F.lit(float(unit_micros))


def hours(micros: ColumnOrName) -> Column:
    return micros_to(MICROS_PER_HOUR, micros)


def minutes(micros: ColumnOrName) -> Column:
    return micros_to(MICROS_PER_MINUTE, micros)


def days(micros: ColumnOrName) -> Column:
    return micros_to(MICROS_PER_DAY, micros)


def clip(x: ColumnOrName, lower, upper) -> Column:
    """``x`` limited to [lower, upper]; null stays null."""
    c = _col(x)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(F.lit(lower), F.least(F.lit(upper), c)))


def round_scaled(x: ColumnOrName, digits: int) -> Column:
    """ROUND(x, digits) of a double, as the warehouse engine computes it:
    scale by 10^digits, round half away from zero to an integer, scale back.

    Rounding the shortest decimal text instead (plain ``F.round`` on a double)
    disagrees on values such as 1.005, so every KPI goes through here.
    """
    factor = float(10**digits)
    return F.round(_col(x).cast("double") * F.lit(factor), 0) / F.lit(factor)


def nullif_zero(x: ColumnOrName) -> Column:
    return F.nullif(_col(x), F.lit(0))


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` as a double, null when the divisor is zero or null."""
    return _col(num).cast("double") / nullif_zero(_col(den)).cast("double")


def trunc_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Integer division of two integers, truncated towards zero (the source
    database's ``bigint / bigint``), as a long; null on a zero divisor."""
    return F.call_function("div", _wide(num), _wide(nullif_zero(den)))


def _wide(x: ColumnOrName) -> Column:
    return _col(x).cast("decimal(38,0)")


def round_ratio(num: ColumnOrName, den: ColumnOrName, digits: int) -> Column:
    """ROUND(num / den, digits) of two integers in exact decimals, ties away
    from zero, as ``decimal(20 + digits, digits)``; null on a zero divisor.

    The quotient is never formed with a limited scale: ``2 * |num| * 10^digits
    + |den|`` is divided as an integer by ``2 * |den|``, so a value on a tie
    is seen as one.  Exact while ``|num| * 10^digits`` stays below 10^37 and
    the scaled result below 2^63; both hold for any sum of microseconds.
    """
    n, d = _wide(num), _wide(nullif_zero(den))
    size = F.call_function(
        "div",
        (F.abs(n) * F.lit(2 * 10**digits) + F.abs(d)).cast("decimal(38,0)"),
        (F.abs(d) * F.lit(2)).cast("decimal(38,0)"),
    )
    signed = F.when((n < 0) == (d < 0), size).otherwise(-size)
    return scaled_decimal(signed, digits)


def scaled_decimal(units: ColumnOrName, digits: int) -> Column:
    """The integer ``units`` times 10^-digits as ``decimal(20 + digits, digits)``."""
    place = F.lit(Decimal(1).scaleb(-digits))
    return (_col(units).cast("decimal(19,0)") * place).cast(f"decimal({20 + digits},{digits})")


def units_of(x: ColumnOrName, digits: int) -> Column:
    """A decimal with ``digits`` places as an integer count of its last place."""
    return (_col(x) * F.lit(10**digits)).cast("decimal(38,0)")
