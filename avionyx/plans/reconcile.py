"""K7: warehouse reports side by side with the source-side reports.

A full outer join on (manufacturer, year[, role]); the warehouse year is
compared as text.  For every metric there is the warehouse value
(``<m>_dw``), the source value (``<m>_src``) and their difference
(``<m>_diff`` = dw - src, null when either side is missing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import baseline, kpis

UTILIZATION_METRICS = ("FH", "TakeOff", "ADOSS", "ADOSU", "ADOS", "ADIS", "DU", "DC", "DYR", "CNR", "TDR", "ADD")
REPORTING_METRICS = ("RRh", "RRc")


def reconcile(dw: DataFrame, src: DataFrame, keys: list[str], metrics: tuple[str, ...]) -> DataFrame:
    left = dw.select(
        *[F.col(k).cast("string").alias(k) for k in keys], *[F.col(m).alias(f"{m}_dw") for m in metrics]
    ).withColumn("_in_dw", F.lit(True))
    right = src.select(
        *[F.col(k).cast("string").alias(k) for k in keys], *[F.col(m).alias(f"{m}_src") for m in metrics]
    ).withColumn("_in_src", F.lit(True))
    j = left.join(right, keys, "full_outer")
    cols = [*keys]
    for m in metrics:
        cols += [f"{m}_dw", f"{m}_src", (F.col(f"{m}_dw") - F.col(f"{m}_src")).alias(f"{m}_diff")]
    cols += [
        F.coalesce("_in_dw", F.lit(False)).alias("in_warehouse"),
        F.coalesce("_in_src", F.lit(False)).alias("in_sources"),
    ]
    return j.select(*cols).orderBy(*keys)


def reconcile_report(name: str, wh, src) -> DataFrame:
    """The named report from a warehouse beside the same from the sources."""
    keys = ["manufacturer", "year"] + (["role"] if name == "reporting_per_role" else [])
    metrics = UTILIZATION_METRICS if name == "utilization" else REPORTING_METRICS
    sources = baseline.as_doubles(getattr(baseline, f"{name}_baseline")(src))
    return reconcile(getattr(kpis, name)(wh), sources, keys, metrics)
