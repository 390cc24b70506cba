"""Manufacturer classification of registrations (J11) and the
manufacturer -> registrations mapping (A12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import MANUFACTURERS
from .joins import bounded_broadcast


def manufacturer_classes(lookup: DataFrame) -> DataFrame:
    """One row per registration of the lookup listed under a known
    manufacturer: (reg, manufacturer).  A registration listed under both is
    classified by the first manufacturer of the fixed list."""
    known = lookup.filter(F.col("aircraft_manufacturer").isin(*MANUFACTURERS))
    priority = F.array_position(F.array(*[F.lit(m) for m in MANUFACTURERS]), F.col("aircraft_manufacturer"))
    return known.groupBy(F.col("aircraft_reg_code").alias("_reg")).agg(
        F.min_by("aircraft_manufacturer", priority).alias("_class")
    )


def classify_manufacturer(df: DataFrame, lookup: DataFrame, reg: str = "aircraftregistration") -> DataFrame:
    """Adds ``manufacturer``: the lookup class of ``reg``, or ``reg`` itself
    when the registration is not listed under a known manufacturer (null
    stays null).

    The class table is broadcast only if the lookup is within the broadcast
    row limit (it has at most one row per lookup row); otherwise this is a
    shuffle join.
    """
    classes = manufacturer_classes(lookup)
    if bounded_broadcast(lookup) is not lookup:
        classes = F.broadcast(classes)
    return (
        df.join(classes, df[reg] == classes["_reg"], "left")
        .withColumn("manufacturer", F.coalesce(F.col("_class"), F.col(reg)))
        .drop("_reg", "_class")
    )


def aircraft_per_manufacturer(lookup: DataFrame) -> DataFrame:
    """The manufacturer -> registrations mapping, one row per pair, with
    the lookup line that gives the list order.

    Kept flat on purpose: with two manufacturers, a list per manufacturer
    would put half of the lookup into one row and one task.  Consumers join
    on it (``classify_manufacturer``) instead of building IN lists.
    """
    line = F.col("lookup_line") if "lookup_line" in lookup.columns else F.lit(None).cast("long")
    return lookup.select(
        F.col("aircraft_manufacturer").alias("manufacturer"),
        F.col("aircraft_reg_code").alias("registration"),
        line.alias("lookup_line"),
    )
