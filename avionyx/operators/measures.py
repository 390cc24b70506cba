"""Per-row measures of flights, maintenance windows and reports.

Two families, kept apart on purpose because their definitions differ:

* warehouse measures (what the facts are built from): a flight without an
  actual departure counts as cancelled; a delay needs a delay code;
  maintenance days are clipped to [0, 1] per window;
* source-side ("baseline") measures: only the ``cancelled`` flag cancels;
  a delay is any arrival more than 15 minutes late; days are not clipped and
  a missing time gives a null measure.

Durations are integer microseconds (``*_us``); ``functions.numeric`` turns
sums of them into hours, minutes or days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import MICROS_PER_DAY, MICROS_PER_MINUTE, clip, micros_between

# Fixed value: a flight is delayed when it arrives more than 15 minutes late.
DELAY_THRESHOLD_US = 15 * MICROS_PER_MINUTE


def _flag(name: str) -> Column:
    """A nullable boolean source flag, null read as false."""
    return F.coalesce(F.col(name), F.lit(False))


def _int(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# --- flights -----------------------------------------------------------------


def flight_measures(flights: DataFrame) -> DataFrame:
    """Warehouse measures per flight, added as columns.

    is_cancelled  cancelled, or no actual departure
    flight_us     0 if cancelled, else actual arrival - actual departure (0 if unknown)
    Takeoffs      1 - is_cancelled;  CFC  is_cancelled as 0/1
    is_delayed    delay code present and arrival more than 15 min late (not gated on cancellation)
    delay_us      full arrival delay if delayed, else 0;  DFC  is_delayed as 0/1
    """
    cancelled = _flag("cancelled") | F.col("actualdeparture").isNull()
    flown = micros_between("actualdeparture", "actualarrival")
    late = micros_between("scheduledarrival", "actualarrival")
    delayed = F.col("delaycode").isNotNull() & F.coalesce(late > F.lit(DELAY_THRESHOLD_US), F.lit(False))
    return (
        flights.withColumn("is_cancelled", cancelled)
        .withColumn("flight_us", F.when(cancelled, F.lit(0)).otherwise(F.coalesce(flown, F.lit(0))).cast("long"))
        .withColumn("Takeoffs", _int(~cancelled))
        .withColumn("CFC", _int(cancelled))
        .withColumn("is_delayed", delayed)
        .withColumn("delay_us", F.when(delayed, late).otherwise(F.lit(0)).cast("long"))
        .withColumn("DFC", _int(delayed))
    )


def baseline_flight_measures(flights: DataFrame) -> DataFrame:
    """Source-side measures per flight (only ``cancelled`` cancels).

    flight_us      0 if cancelled, else arrival - departure (null if a time is null)
    cycles         0 if cancelled else 1;  cancellations  the opposite
    delays         0 if cancelled, else 1 when more than 15 min late (no delay code needed)
    delay_us       0 if cancelled, else the delay when more than 15 min late, else 0
    """
    cancelled = _flag("cancelled")
    flown = micros_between("actualdeparture", "actualarrival")
    late = micros_between("scheduledarrival", "actualarrival")
    is_late = F.coalesce(late > F.lit(DELAY_THRESHOLD_US), F.lit(False))
    return (
        flights.withColumn("flight_us", F.when(cancelled, F.lit(0)).otherwise(flown).cast("long"))
        .withColumn("cycles", _int(~cancelled))
        .withColumn("cancellations", _int(cancelled))
        .withColumn("delays", F.when(cancelled, F.lit(0)).otherwise(_int(is_late)))
        .withColumn("delay_us", F.when(cancelled | ~is_late, F.lit(0)).otherwise(late).cast("long"))
    )


# --- maintenance ---------------------------------------------------------------

MAINTENANCE_REQUIRED = ("scheduleddeparture", "scheduledarrival", "aircraftregistration")


def maintenance_measures(maintenance: DataFrame) -> DataFrame:
    """Warehouse measures per maintenance window.

    Rows missing a scheduled time or the registration are dropped.  The
    window length, as a fraction of a day, is clipped to [0, 1] per window
    and counted entirely in the month it starts; it goes to the scheduled
    column when ``programmed`` (null read as false), else to the
    unscheduled one.
    """
    kept = maintenance.dropna(subset=list(MAINTENANCE_REQUIRED))
    out_us = clip(micros_between("scheduleddeparture", "scheduledarrival"), 0, MICROS_PER_DAY)
    programmed = _flag("programmed")
    return (
        kept.withColumn("Year", F.year("scheduleddeparture"))
        .withColumn("Month_Num", F.month("scheduleddeparture"))
        .withColumn("out_us", out_us.cast("long"))
        .withColumn("scheduled_us", F.when(programmed, F.col("out_us")).otherwise(F.lit(0)).cast("long"))
        .withColumn("unscheduled_us", F.when(programmed, F.lit(0)).otherwise(F.col("out_us")).cast("long"))
    )


def baseline_maintenance_measures(maintenance: DataFrame) -> DataFrame:
    """Source-side measures per window: unclipped length, split by
    ``programmed`` (null goes to unscheduled); null when a time is null."""
    out_us = micros_between("scheduleddeparture", "scheduledarrival")
    programmed = _flag("programmed")
    return maintenance.withColumn(
        "scheduled_us", F.when(programmed, out_us).otherwise(F.lit(0)).cast("long")
    ).withColumn("unscheduled_us", F.when(programmed, F.lit(0)).otherwise(out_us).cast("long"))


# --- reports -----------------------------------------------------------------

# The airport recorded for a reporter missing from the
# personnel file, and the two reporter roles.
NO_AIRPORT = "NONE"
ROLE_MAINTENANCE = "MAREP"
ROLE_PILOT = "PIREP"


def report_airport(reports: DataFrame, personnel: DataFrame) -> DataFrame:
    """J1 + P14 + P16: each report with the airport of its reporter.

    Both keys are compared as text.  Reporters missing from the personnel
    file (or with a null id) get ``NONE``.  A reporter listed twice would
    multiply the report, as a left join does; ``personnel`` may be hinted
    for broadcast by the caller after a size check, otherwise this is a
    shuffle join whose skewed keys AQE splits.
    """
    people = personnel.select(
        F.col("reporteurid").cast("string").alias("_rid"),
        F.col("airport").alias("_airport"),
    )
    joined = reports.withColumn("_rid", F.col("reporteurid").cast("string")).join(people, "_rid", "left")
    return joined.drop("_rid").withColumn("airport", F.coalesce(F.col("_airport"), F.lit(NO_AIRPORT))).drop(
        "_airport"
    )


def role_of_airport(airport: str | Column = "Airport") -> Column:
    """A logbook line with a known airport is a maintenance report."""
    a = F.col(airport) if isinstance(airport, str) else airport
    return F.when(a != F.lit(NO_AIRPORT), F.lit(ROLE_MAINTENANCE)).otherwise(F.lit(ROLE_PILOT))
