"""Fact aggregation (A1-A3), key resolution (J2-J4) and fact rows.

Aggregation happens on natural keys first and the (much smaller) grouped
rows are then joined to the dimensions, never the raw rows.  Grouped rows
whose natural key is missing from a dimension are not loaded; they are
returned as rejects instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import day_of, days, days_in_month, hours, minutes
from ..sources import schemas
from .measures import flight_measures, maintenance_measures, report_airport

REG = "aircraftregistration"


class KeyLookup(NamedTuple):
    """Resolve ``key`` from ``dim`` by matching fact columns to dimension columns."""

    dim: DataFrame
    on: Mapping[str, str]  # fact column -> dimension column
    key: str


# --- A1 ----------------------------------------------------------------------


def daily_flight_totals(flights: DataFrame, keep_null_registration: bool = False) -> DataFrame:
    """Sums of the flight measures per (day of scheduled departure, registration).

    Returns Full_Date, aircraftregistration, flight_us, Takeoffs, CFC, DFC,
    delay_us (integer sums).  Rows with no departure day are dropped; rows
    with no registration too, unless ``keep_null_registration`` (the Dates
    dimension counts their days).
    """
    m = flight_measures(flights).withColumn("Full_Date", day_of("scheduleddeparture"))
    keep = F.col("Full_Date").isNotNull()
    if not keep_null_registration:
        keep = keep & F.col(REG).isNotNull()
    return (
        m.filter(keep)
        .groupBy("Full_Date", REG)
        .agg(
            F.sum("flight_us").alias("flight_us"),
            F.sum("Takeoffs").alias("Takeoffs"),
            F.sum("CFC").alias("CFC"),
            F.sum("DFC").alias("DFC"),
            F.sum("delay_us").alias("delay_us"),
        )
    )


def daily_flight_measures(totals: DataFrame) -> DataFrame:
    """Fact measures from daily totals: FH hours; Takeoffs, DFC, CFC as int;
    TDM total delay minutes rounded half to even, stored as FLOAT."""
    return totals.filter(F.col(REG).isNotNull()).select(
        "Full_Date",
        REG,
        hours("flight_us").cast("float").alias("FH"),
        F.col("Takeoffs").cast("int").alias("Takeoffs"),
        F.col("DFC").cast("int").alias("DFC"),
        F.col("CFC").cast("int").alias("CFC"),
        F.bround(minutes("delay_us"), 0).cast("float").alias("TDM"),
    )


def daily_flight_aggregates(flights: DataFrame) -> DataFrame:
    """A1 before key lookup: (Full_Date, registration, FH, Takeoffs, DFC, CFC, TDM)."""
    return daily_flight_measures(daily_flight_totals(flights))


# --- A2 ----------------------------------------------------------------------


def monthly_maintenance_aggregates(maintenance: DataFrame) -> DataFrame:
    """A2 before key lookup: per (Year, Month_Num, registration) with at least
    one window, ADOSS/ADOSU days out of service and ADIS = days of the month
    minus both (may go negative; the domain check reports it)."""
    g = (
        maintenance_measures(maintenance)
        .groupBy("Year", "Month_Num", REG)
        .agg(F.sum("scheduled_us").alias("_s"), F.sum("unscheduled_us").alias("_u"))
    )
    adoss, adosu = days("_s"), days("_u")
    return g.select(
        "Year",
        "Month_Num",
        REG,
        (days_in_month("Year", "Month_Num").cast("double") - (adoss + adosu)).cast("float").alias("ADIS"),
        adoss.cast("float").alias("ADOSS"),
        adosu.cast("float").alias("ADOSU"),
    )


# --- A3 ----------------------------------------------------------------------


def reporter_counts(reports: DataFrame) -> DataFrame:
    """Reports per (Year, Month_Num, registration, reporter); reports without
    a date or registration are not counted.  Works on a stream too."""
    dated = reports.filter(F.col("reportingdate").isNotNull() & F.col(REG).isNotNull())
    return dated.groupBy(
        F.year("reportingdate").alias("Year"), F.month("reportingdate").alias("Month_Num"), REG, "reporteurid"
    ).agg(F.count(F.lit(1)).alias("n"))


def logbook_of_reporters(counts: DataFrame, personnel: DataFrame) -> DataFrame:
    """``reporter_counts`` summed per airport of the reporter."""
    return (
        report_airport(counts, personnel)
        .groupBy("Year", "Month_Num", F.col("airport").alias("Airport"), REG)
        .agg(F.sum("n").cast("int").alias("Log_Count"))
    )


def logbook_aggregates(reports: DataFrame, personnel: DataFrame) -> DataFrame:
    """A3 before key lookup: number of reports per (Year, Month_Num, Airport,
    registration).  Reports are counted per reporter first, so the personnel
    file meets counts, not raw reports."""
    return logbook_of_reporters(reporter_counts(reports), personnel)


# --- key resolution ------------------------------------------------------------


def resolve_keys(aggregates: DataFrame, lookups: Sequence[KeyLookup], how: str = "left") -> DataFrame:
    """Attach surrogate keys by natural key (single or composite).

    ``how='left'`` keeps unresolved rows with a null key (split them with
    ``loaded_rows`` / ``rejected_rows``); ``how='inner'`` drops them.
    Dimensions are expected to be hinted for broadcast after a size check.
    """
    out = aggregates
    for lk in lookups:
        d = lk.dim.select(F.col(lk.key), *[F.col(dc).alias(fc) for fc, dc in lk.on.items()])
        out = out.join(d, list(lk.on), how)
    return out


def loaded_rows(resolved: DataFrame, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return resolved.filter(ok).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def rejected_rows(resolved: DataFrame, keys: Sequence[str], natural: Sequence[str]) -> DataFrame:
    """Grouped rows that found no key, with the natural key and which
    dimension key is missing (``missing`` is a comma-separated list)."""
    bad = F.lit(False)
    for k in keys:
        bad = bad | F.col(k).isNull()
    missing = F.concat_ws(",", *[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])
    return resolved.filter(bad).select(*natural, missing.alias("missing"))


FLIGHT_DAILY_KEYS = ("Date_ID", "Aircraft_ID")
MONTHLY_KEYS = ("Month_ID", "Aircraft_ID")
LOGBOOK_KEYS = ("Month_ID", "Aircraft_ID")


def flight_daily_lookups(dates: DataFrame, aircrafts: DataFrame) -> list[KeyLookup]:
    return [
        KeyLookup(dates, {"Full_Date": "Full_Date"}, "Date_ID"),
        KeyLookup(aircrafts, {REG: "Aircraft_Registration_Code"}, "Aircraft_ID"),
    ]


def month_lookups(months: DataFrame, aircrafts: DataFrame) -> list[KeyLookup]:
    return [
        KeyLookup(months, {"Month_Num": "Month_Num", "Year": "Year"}, "Month_ID"),
        KeyLookup(aircrafts, {REG: "Aircraft_Registration_Code"}, "Aircraft_ID"),
    ]


def flight_daily_fact(aggregates: DataFrame, dates: DataFrame, aircrafts: DataFrame) -> DataFrame:
    resolved = resolve_keys(aggregates, flight_daily_lookups(dates, aircrafts), "inner")
    return loaded_rows(resolved, FLIGHT_DAILY_KEYS, schemas.FLIGHT_OPERATIONS_DAILY)


def monthly_fact(aggregates: DataFrame, months: DataFrame, aircrafts: DataFrame) -> DataFrame:
    resolved = resolve_keys(aggregates, month_lookups(months, aircrafts), "inner")
    return loaded_rows(resolved, MONTHLY_KEYS, schemas.AIRCRAFT_MONTHLY_SUMMARY)


def logbook_fact(aggregates: DataFrame, months: DataFrame, aircrafts: DataFrame) -> DataFrame:
    resolved = resolve_keys(aggregates, month_lookups(months, aircrafts), "inner")
    return loaded_rows(resolved, LOGBOOK_KEYS, schemas.LOGBOOKS)
