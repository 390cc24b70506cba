"""Source-side KPI reports (K4-K6): the warehouse reports computed straight
from the raw sources, with the source database's semantics.

Differences to the warehouse reports are intended and kept: only the
``cancelled`` flag cancels; a delay needs no delay code; maintenance days are
not clipped; the aircraft count is taken over flights and maintenance
together; an aircraft unknown to the lookup forms its own group (named by
its registration); years are text; the role is the recorded reporter class.

The source database divides integers with truncation in two places
(TakeOff and the ratio inside TDR); ``trunc_div`` reproduces that.  Its
decimals stay decimals: every metric is a quotient of two exact integer sums,
rounded once, ties away from zero (``round_ratio``), with the places that the
report states (2 for hours, days, DU, DC, ADD; 4 for DYR and CNR; 3 and 2 for
the rates).  Nothing passes through a double, so a value on a rounding tie is
the one that exact numerics give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    MICROS_PER_DAY,
    MICROS_PER_HOUR,
    MICROS_PER_MINUTE,
    round_ratio,
    scaled_decimal,
    trunc_div,
    units_of,
    year_text,
)
from ..operators.classify import classify_manufacturer
from ..operators.measures import baseline_flight_measures, baseline_maintenance_measures
from ..sources import FleetSources

REG = "aircraftregistration"
KEYS = ["manufacturer", "year"]
DAYS_PER_YEAR = 365

EVENT_COLUMNS = (
    "flight_us",
    "cycles",
    "cancellations",
    "delays",
    "delay_us",
    "scheduled_us",
    "unscheduled_us",
)


def utilization_events(flights: DataFrame, maintenance: DataFrame) -> DataFrame:
    """Flight and maintenance measures in one frame, each side's missing
    measures zero-filled, with the year (text) of the scheduled departure."""
    f = baseline_flight_measures(flights).select(
        "aircraftregistration",
        year_text("scheduleddeparture").alias("year"),
        "flight_us",
        "cycles",
        "cancellations",
        "delays",
        "delay_us",
        F.lit(0).cast("long").alias("scheduled_us"),
        F.lit(0).cast("long").alias("unscheduled_us"),
    )
    m = baseline_maintenance_measures(maintenance).select(
        "aircraftregistration",
        year_text("scheduleddeparture").alias("year"),
        F.lit(0).cast("long").alias("flight_us"),
        F.lit(0).alias("cycles"),
        F.lit(0).alias("cancellations"),
        F.lit(0).alias("delays"),
        F.lit(0).cast("long").alias("delay_us"),
        "scheduled_us",
        "unscheduled_us",
    )
    return f.unionByName(m)


def utilization_baseline(src: FleetSources) -> DataFrame:
    """K4 (A9): per (manufacturer, year) over the union of flights and maintenance.

    Raw rows are summed per (registration, year) first; only these few rows
    meet the lookup, and one of them is one aircraft of its year.
    """
    per_aircraft = (
        utilization_events(src.flights, src.maintenance)
        .groupBy(REG, "year")
        .agg(*[F.sum(c).alias(c) for c in EVENT_COLUMNS])
    )
    g = (
        classify_manufacturer(per_aircraft, src.aircraft)
        .groupBy(*KEYS)
        .agg(F.count(REG).alias("n"), *[F.sum(c).alias(c) for c in EVENT_COLUMNS])
    )
    per_aircraft_days = _wide("n") * F.lit(MICROS_PER_DAY)
    fh = round_ratio("flight_us", _wide("n") * F.lit(MICROS_PER_HOUR), 2)
    takeoff = trunc_div("cycles", "n")
    ados = round_ratio(_wide("scheduled_us") + _wide("unscheduled_us"), per_aircraft_days, 2)
    # in hundredths, the places of FH and of the days
    in_service = F.lit(100 * DAYS_PER_YEAR) - units_of(ados, 2)
    return g.select(
        *KEYS,
        fh.alias("FH"),
        scaled_decimal(takeoff * 100, 2).alias("TakeOff"),
        round_ratio("scheduled_us", per_aircraft_days, 2).alias("ADOSS"),
        round_ratio("unscheduled_us", per_aircraft_days, 2).alias("ADOSU"),
        ados.alias("ADOS"),
        scaled_decimal(in_service, 2).alias("ADIS"),
        round_ratio(units_of(fh, 2), in_service * 24, 2).alias("DU"),
        round_ratio(takeoff * 100, in_service, 2).alias("DC"),
        _times(round_ratio("delays", "cycles", 4), 100, 4).alias("DYR"),
        _times(round_ratio("cancellations", "cycles", 4), 100, 4).alias("CNR"),
        scaled_decimal((100 - trunc_div(100 * (F.col("delays") + F.col("cancellations")), "cycles")) * 100, 2).alias("TDR"),
        _times(round_ratio("delay_us", _wide("delays") * F.lit(MICROS_PER_MINUTE), 2), 100, 2).alias("ADD"),
    ).orderBy(*KEYS)


def _wide(c: str):
    return F.col(c).cast("decimal(28,0)")


def _times(x, factor: int, digits: int):
    """A rounded ratio as percent, per thousand and the like, with its places kept."""
    return scaled_decimal(units_of(x, digits) * factor, digits)


def as_doubles(report: DataFrame) -> DataFrame:
    """A report with its decimals as the nearest doubles, for comparison with the warehouse reports."""
    return report.select(
        *[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in report.dtypes]
    )


def flight_utilization_baseline(src: FleetSources) -> DataFrame:
    """A10: per (manufacturer, year) flown microseconds and cycles of the flights."""
    sums = [F.sum("flight_us").alias("flight_us"), F.sum("cycles").alias("cycles")]
    per_aircraft = (
        baseline_flight_measures(src.flights)
        .groupBy(REG, year_text("scheduleddeparture").alias("year"))
        .agg(*sums)
    )
    return classify_manufacturer(per_aircraft, src.aircraft).groupBy(*KEYS).agg(*sums)


def report_counts_baseline(src: FleetSources, by_role: bool = False) -> DataFrame:
    """Number of raw reports per (manufacturer, year[, recorded role])."""
    role = ["role"] if by_role else []
    per_aircraft = (
        src.reports.select(REG, year_text("reportingdate").alias("year"), F.col("reporteurclass").alias("role"))
        .groupBy(REG, "year", *role)
        .agg(F.count(F.lit(1)).alias("counter"))
    )
    classified = classify_manufacturer(per_aircraft, src.aircraft)
    return classified.groupBy(*KEYS, *role).agg(F.sum("counter").alias("counter"))


def _rates(src: FleetSources, by_role: bool) -> DataFrame:
    rep = report_counts_baseline(src, by_role)
    util = flight_utilization_baseline(src)
    keys = KEYS + (["role"] if by_role else [])
    return (
        rep.join(util, KEYS)
        .select(
            *keys,
            _times(round_ratio(_wide("counter") * F.lit(MICROS_PER_HOUR), "flight_us", 3), 1000, 3).alias("RRh"),
            _times(round_ratio("counter", "cycles", 2), 100, 2).alias("RRc"),
        )
        .orderBy(*keys)
    )


def reporting_baseline(src: FleetSources) -> DataFrame:
    """K5: reports per 1000 flight hours and per 100 cycles, from the sources."""
    return _rates(src, by_role=False)


def reporting_per_role_baseline(src: FleetSources) -> DataFrame:
    """K6: K5 split by the recorded reporter class."""
    return _rates(src, by_role=True)
