"""Dimension members (D1-D3) and their keyed tables.

Members are distinct natural keys with attributes; ``keys.assign_surrogate_keys``
turns them into dimension tables.  All dedupes are aggregations, which Spark
combines map-side, so a registration or a day holding a large share of the
rows never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_parts, day_of
from ..sources import schemas
from .keys import assign_surrogate_keys

REG = "aircraftregistration"
AIRCRAFT_ATTRS = ("Manufacturer_Serial_Number", "Aircraft_Model", "Aircraft_Manufacturer_Class")


def aircraft_members(lookup: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """Lookup rows, first row per registration in file order (W2), then
    registrations seen in reports but not in the lookup, with null attributes.

    ``source_rank`` is 0 for lookup rows and 1 for report-only ones; keys are
    numbered in (source_rank, registration) order, so the lookup fleet gets
    the low keys.  A null or empty-cell registration cannot be a member.
    """
    attributes = [F.col(c) for c in ("manufacturer_serial_number", "aircraft_model", "aircraft_manufacturer")]
    # without line numbers the smallest attributes win
    line = F.col("lookup_line") if "lookup_line" in lookup.columns else F.struct(*attributes)
    first = (
        lookup.filter(F.col("aircraft_reg_code").isNotNull())
        .groupBy(F.col("aircraft_reg_code").alias("Aircraft_Registration_Code"))
        .agg(
            F.min_by(
                F.struct(
                    F.col("manufacturer_serial_number").alias("Manufacturer_Serial_Number"),
                    F.col("aircraft_model").alias("Aircraft_Model"),
                    F.col("aircraft_manufacturer").alias("Aircraft_Manufacturer_Class"),
                ),
                line,
            ).alias("_a")
        )
        .select("Aircraft_Registration_Code", *[F.col(f"_a.{a}").alias(a) for a in AIRCRAFT_ATTRS])
        .withColumn("source_rank", F.lit(0))
    )
    if reports is None:
        return first
    seen = (
        reports.select(F.col(REG).alias("Aircraft_Registration_Code"))
        .filter(F.col("Aircraft_Registration_Code").isNotNull())
        .distinct()
        .join(first.select("Aircraft_Registration_Code"), "Aircraft_Registration_Code", "left_anti")
    )
    extra = seen.select(
        "Aircraft_Registration_Code",
        *[F.lit(None).cast("string").alias(a) for a in AIRCRAFT_ATTRS],
        F.lit(1).alias("source_rank"),
    )
    return first.unionByName(extra)


def aircraft_dimension(members: DataFrame) -> DataFrame:
    keyed = assign_surrogate_keys(members, ["source_rank", "Aircraft_Registration_Code"], "Aircraft_ID")
    return keyed.select(*schemas.AIRCRAFTS.fieldNames())


def date_members(flights: DataFrame, ts: str = "scheduleddeparture") -> DataFrame:
    """Distinct calendar days of the scheduled departures (nulls dropped)."""
    days = flights.select(day_of(ts).alias("Full_Date")).filter(F.col("Full_Date").isNotNull()).distinct()
    return days.select("Full_Date", *date_parts("Full_Date"))


def date_dimension(members: DataFrame) -> DataFrame:
    return assign_surrogate_keys(members, ["Full_Date"], "Date_ID").select(*schemas.DATES.fieldNames())


def month_members(reports: DataFrame, maintenance: DataFrame) -> DataFrame:
    """D3: distinct (month, year) of report dates and maintenance starts."""
    stamps = reports.select(F.col("reportingdate").alias("_ts")).unionByName(
        maintenance.select(F.col("scheduleddeparture").alias("_ts"))
    )
    return (
        stamps.filter(F.col("_ts").isNotNull())
        .select(F.month("_ts").alias("Month_Num"), F.year("_ts").alias("Year"))
        .distinct()
    )


def month_dimension(members: DataFrame) -> DataFrame:
    return assign_surrogate_keys(members, ["Year", "Month_Num"], "Month_ID").select(*schemas.MONTHS.fieldNames())
