"""Warehouse KPI reports (K1-K3) and the yearly totals behind them.

Reports come back ordered by manufacturer, year (and role), as the reference
orders them.

Each report is two star-join aggregates per (manufacturer, year) joined on
(manufacturer, year).  A null manufacturer never matches in that join, and a
year present on only one side is dropped, as in an inner SQL join.

Count-distinct of aircraft is exact (Spark plans it as a two-level
aggregation keyed by aircraft first, so a single hot manufacturer-year does
not funnel raw rows into one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import round_scaled as R
from ..functions import safe_div
from ..operators.measures import role_of_airport

KEYS = ["manufacturer", "year"]

# Fixed value of the KPI formulas: days in a year (also in leap years).
DAYS_PER_YEAR = 365.0


def _by_year(fact: DataFrame, aircrafts: DataFrame, calendar: DataFrame, calendar_key: str) -> DataFrame:
    return fact.join(aircrafts, "Aircraft_ID").join(calendar, calendar_key)


def yearly_flight_totals(wh) -> DataFrame:
    """A4: per (manufacturer, year) FH, Takeoffs, TDM, CFC, DFC sums and the
    number of distinct aircraft that flew."""
    return (
        _by_year(wh.flight_daily, wh.aircrafts, wh.dates, "Date_ID")
        .groupBy(F.col("Aircraft_Manufacturer_Class").alias("manufacturer"), F.col("Year").alias("year"))
        .agg(
            F.sum("FH").alias("flight_hours"),
            F.sum("Takeoffs").alias("departures"),
            F.sum("TDM").alias("delay_minutes"),
            F.sum("CFC").alias("cancellations"),
            F.sum("DFC").alias("delays"),
            F.countDistinct("Aircraft_ID").alias("fleet"),
        )
    )


def yearly_maintenance_totals(wh) -> DataFrame:
    """A5: per (manufacturer, year) ADOSS, ADOSU, ADIS sums and the number of
    distinct aircraft with maintenance."""
    return (
        _by_year(wh.monthly, wh.aircrafts, wh.months, "Month_ID")
        .groupBy(F.col("Aircraft_Manufacturer_Class").alias("manufacturer"), F.col("Year").alias("year"))
        .agg(
            F.sum("ADOSS").alias("scheduled_days"),
            F.sum("ADOSU").alias("unscheduled_days"),
            F.sum("ADIS").alias("service_days"),
            F.countDistinct("Aircraft_ID").alias("fleet"),
        )
    )


def yearly_utilization(wh) -> DataFrame:
    """Per (manufacturer, year) FH and Takeoffs sums."""
    return (
        _by_year(wh.flight_daily, wh.aircrafts, wh.dates, "Date_ID")
        .groupBy(F.col("Aircraft_Manufacturer_Class").alias("manufacturer"), F.col("Year").alias("year"))
        .agg(F.sum("FH").alias("flight_hours"), F.sum("Takeoffs").alias("departures"))
    )


def yearly_report_totals(wh) -> DataFrame:
    """Per (manufacturer, year) number of logbook reports."""
    return (
        _by_year(wh.logbooks, wh.aircrafts, wh.months, "Month_ID")
        .groupBy(F.col("Aircraft_Manufacturer_Class").alias("manufacturer"), F.col("Year").alias("year"))
        .agg(F.sum("Log_Count").alias("reports"))
    )


def yearly_role_totals(wh) -> DataFrame:
    """Reports per (manufacturer, year, role); role derived from the airport."""
    return (
        _by_year(wh.logbooks, wh.aircrafts, wh.months, "Month_ID")
        .groupBy(
            F.col("Aircraft_Manufacturer_Class").alias("manufacturer"),
            F.col("Year").alias("year"),
            role_of_airport("Airport").alias("role"),
        )
        .agg(F.sum("Log_Count").alias("reports"))
    )


def utilization(wh) -> DataFrame:
    """K1: utilization, maintenance and punctuality KPIs per manufacturer and year."""
    y = yearly_flight_totals(wh).withColumnRenamed("fleet", "n_f")
    m = yearly_maintenance_totals(wh).withColumnRenamed("fleet", "n_m")
    j = y.join(m, KEYS)
    fh = R(safe_div("flight_hours", "n_f"), 2)
    takeoff = R(safe_div("departures", "n_f"), 2)
    ados = R(safe_div(F.col("scheduled_days") + F.col("unscheduled_days"), "n_m"), 2)
    in_service = F.lit(DAYS_PER_YEAR) - ados
    return j.select(
        "manufacturer",
        "year",
        fh.alias("FH"),
        takeoff.alias("TakeOff"),
        R(safe_div("scheduled_days", "n_m"), 2).alias("ADOSS"),
        R(safe_div("unscheduled_days", "n_m"), 2).alias("ADOSU"),
        ados.alias("ADOS"),
        R(safe_div("service_days", "n_m"), 2).alias("ADIS"),
        R(safe_div(fh, in_service * 24), 2).alias("DU"),
        R(safe_div(takeoff, in_service), 2).alias("DC"),
        (100 * R(safe_div("delays", "departures"), 4)).alias("DYR"),
        (100 * R(safe_div("cancellations", "departures"), 4)).alias("CNR"),
        F.ceil(
            F.lit(100.0) - R(safe_div(100 * (F.col("delays") + F.col("cancellations")), "departures"), 2)
        )
        .cast("double")
        .alias("TDR"),
        (100 * R(safe_div("delay_minutes", "delays"), 2)).alias("ADD"),
    ).orderBy(*KEYS)


def _rates(reports: DataFrame, util: DataFrame, keys: list[str], join_keys: list[str]) -> DataFrame:
    j = reports.join(util, join_keys)
    return j.select(
        *keys,
        (1000 * R(safe_div("reports", "flight_hours"), 3)).alias("RRh"),
        (100 * R(safe_div("reports", "departures"), 2)).alias("RRc"),
    )


def reporting(wh) -> DataFrame:
    """K2: reports per 1000 flight hours (RRh) and per 100 take-offs (RRc)."""
    return _rates(yearly_report_totals(wh), yearly_utilization(wh), KEYS, KEYS).orderBy(*KEYS)


def reporting_per_role(wh) -> DataFrame:
    """K3: K2 split by reporter role; the denominators are not split."""
    return _rates(yearly_role_totals(wh), yearly_utilization(wh), KEYS + ["role"], KEYS).orderBy(*KEYS, "role")
