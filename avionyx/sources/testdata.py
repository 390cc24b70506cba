"""Fleet sources derived from the TPC-H-like test tables.

The test tables hold no flights, so the five sources are derived from them by
fixed integer arithmetic (FIXTURES.md section 3): flights from ``lineitem``,
maintenance windows from ``orders``, post-flight reports from ``events``, the
aircraft lookup from ``supplier`` and the personnel file from ``customer``.
Every derivation is a projection (plus a filter), so it stays a narrow,
pushed-down scan and grows with the tables.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .readers import conform


class FleetSources(NamedTuple):
    flights: DataFrame
    maintenance: DataFrame
    reports: DataFrame
    aircraft: DataFrame
    personnel: DataFrame


def _plus_minutes(ts: Column, n: Column) -> Column:
    return F.timestamp_add("MINUTE", n.cast("int"), ts)


def flights_from_lineitem(lineitem: DataFrame) -> DataFrame:
    c = F.col
    k = c("l_orderkey") * 7 + c("l_linenumber")
    # Every timestamp is the ship date plus one integer number of minutes, so
    # each column is a single timestamp_add (minute arithmetic on a
    # timezone-free timestamp is exact, so sums of offsets are equivalent).
    sd_min = k * 37 % 1440
    sa_min = sd_min + 60 + c("l_partkey") % 240
    ad_min = sd_min + k % 30
    ad_missing = ((k % 20 == 0) & (k % 40 != 0)) | (k % 33 == 0)
    ship = c("l_shipdate")
    df = lineitem.select(
        (((c("l_orderkey") * 10 + c("l_linenumber")) * 100000 + c("l_partkey")) * 10000 + c("l_suppkey")).alias("id"),
        c("l_suppkey").cast("string").alias("aircraftregistration"),
        _plus_minutes(ship, sd_min).alias("scheduleddeparture"),
        _plus_minutes(ship, sa_min).alias("scheduledarrival"),
        F.when(ad_missing, F.lit(None)).otherwise(_plus_minutes(ship, ad_min)).alias("actualdeparture"),
        F.when(ad_missing, F.lit(None))
        .otherwise(
            _plus_minutes(ship, F.when(k % 50 == 1, ad_min - 30).otherwise(sa_min + (k * 11) % 60 - 10))
        )
        .alias("actualarrival"),
        (k % 20 == 0).alias("cancelled"),
        F.when(k % 3 != 0, F.lit("D")).alias("delaycode"),
    )
    return conform(df, schemas.FLIGHTS)


def maintenance_from_orders(orders: DataFrame) -> DataFrame:
    c = F.col
    sd_min = c("o_orderkey") * 53 % 1440
    length = F.when(c("o_orderkey") % 50 == 0, F.lit(-60)).otherwise(1 + c("o_orderkey") * 97 % 2880)
    df = orders.select(
        F.floor(c("o_custkey") / 15).cast("long").cast("string").alias("aircraftregistration"),
        _plus_minutes(c("o_orderdate"), sd_min).alias("scheduleddeparture"),
        _plus_minutes(c("o_orderdate"), sd_min + length).alias("scheduledarrival"),
        (c("o_orderstatus") == "F").alias("programmed"),
    )
    return conform(df, schemas.MAINTENANCE)


def reports_from_events(events: DataFrame) -> DataFrame:
    c = F.col
    ground = c("event_type").isin("error", "view")
    shift = (c("event_id") % 84 + 265).cast("int")
    df = events.filter(c("user_id") % 20 != 19).select(
        c("event_id").alias("pfrid"),
        c("user_id").cast("string").alias("aircraftregistration"),
        (c("ts") - F.make_ym_interval(F.lit(0), shift)).alias("reportingdate"),
        F.concat(F.when(ground, F.lit("")).otherwise(F.lit("P")), c("user_id").cast("string")).alias("reporteurid"),
        F.when((c("event_id") % 10 == 0) | ground, F.lit("MAREP")).otherwise(F.lit("PIREP")).alias("reporteurclass"),
    )
    return conform(df, schemas.REPORTS)


def aircraft_lookup_from_supplier(supplier: DataFrame) -> DataFrame:
    c = F.col
    return supplier.filter(c("s_suppkey") % 10 != 9).select(
        c("s_suppkey").cast("string").alias("aircraft_reg_code"),
        c("s_name").alias("manufacturer_serial_number"),
        F.concat(F.lit("M"), (c("s_nationkey") % 12).cast("string")).alias("aircraft_model"),
        F.when(c("s_nationkey") % 5 < 3, F.lit("Airbus")).otherwise(F.lit("Boeing")).alias("aircraft_manufacturer"),
        c("s_suppkey").alias("lookup_line"),
    )


def personnel_from_customer(customer: DataFrame) -> DataFrame:
    c = F.col
    return customer.select(
        c("c_custkey").cast("string").alias("reporteurid"),
        F.concat(F.lit("A"), c("c_nationkey").cast("string")).alias("airport"),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_test_sources(spark: SparkSession, sf_dir: str) -> FleetSources:
    t = lambda name: read_table(spark, sf_dir, name)
    return FleetSources(
        flights=flights_from_lineitem(t("lineitem")),
        maintenance=maintenance_from_orders(t("orders")),
        reports=reports_from_events(t("events")),
        aircraft=aircraft_lookup_from_supplier(t("supplier")),
        personnel=personnel_from_customer(t("customer")),
    )
