"""Column-level helpers (built-in Spark functions only)."""

from .dates import date_code, date_parts, day_of, days_in_month, year_text
from .numeric import (
    MICROS_PER_DAY,
    MICROS_PER_HOUR,
    MICROS_PER_MINUTE,
    clip,
    days,
    hours,
    micros_between,
    minutes,
    nullif_zero,
    round_ratio,
    round_scaled,
    safe_div,
    scaled_decimal,
    trunc_div,
    units_of,
)

__all__ = [
    "MICROS_PER_DAY",
    "MICROS_PER_HOUR",
    "MICROS_PER_MINUTE",
    "clip",
    "date_code",
    "date_parts",
    "day_of",
    "days",
    "days_in_month",
    "hours",
    "micros_between",
    "minutes",
    "nullif_zero",
    "round_ratio",
    "round_scaled",
    "safe_div",
    "scaled_decimal",
    "trunc_div",
    "units_of",
    "year_text",
]
