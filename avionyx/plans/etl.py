"""The ETL run (E1): sources -> cleaning -> dimensions -> facts -> checks ->
stored warehouse, with the violation and reject tables next to it.

``clean`` switches the business rules on or off (the reference asks
interactively); ``reset`` rebuilds the warehouse from scratch, otherwise the
stored dimensions are extended with ``ensure_dimension`` (existing keys kept)
and the new facts are appended.  The load is gated on the declared
constraints, and an appended fact row whose primary key is stored already
breaks one: a violation stops the load before anything is published, as a
failing bulk insert would, and the error names the failed checks.

The overlap rule BR2 reaches across loads.  A load keeps a boundary table
(``_open_flights``): the last flown flights of each aircraft, whose next
departure a later load may still bring, with the other flights of their days.
The facts of those days are stored in a folder of their own.  The next load
judges the boundary flights together with its own, writes the facts of their
days anew and replaces both, so flights loaded in parts by date give the
violations and facts of one load.  A load whose flights depart more than
``OPEN_WINDOW`` before the last stored departure of their aircraft comes too
late to be judged and is refused.  An id names one flight: rows of different
loads that share an id are only removed together while they are in the
boundary table.  Any other day or month whose facts are stored can't be added to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_of
from ..operators import cleaning, facts, keys
from ..operators.joins import bounded_broadcast
from ..session import materialize
from ..sources import FleetSources, schemas
from . import store
from .warehouse import (
    DIMENSION_TABLES,
    FACT_TABLES,
    BuiltWarehouse,
    ConstraintViolation,
    Warehouse,
    build_warehouse,
    gate,
    write_warehouse,
)

OPEN_FLIGHTS = "_open_flights"
# A departure may come in a later load than one up to so much later.
OPEN_WINDOW = "INTERVAL 2 DAYS"

__all__ = ["ConstraintViolation", "LoadReport", "load_warehouse", "stored_row_counts"]


@dataclass(frozen=True)
class LoadReport:
    path: str
    checks: DataFrame  # (table_name, kind, constraint_name, violations)
    violations: DataFrame  # BR1-BR3 findings
    rejects: dict[str, DataFrame]


def _extend(existing: DataFrame, fresh: DataFrame, natural: list[str], key: str) -> DataFrame:
    """Existing members keep their keys; new natural keys get max(key)+1.."""
    members = fresh.drop(key)
    added = keys.ensure_dimension(existing, members, natural, key)
    return bounded_broadcast(materialize(existing.unionByName(added), f"dim-{key}"))


def _rekey(wh: BuiltWarehouse, stored: dict[str, DataFrame]) -> Warehouse:
    aircrafts = _extend(stored["Aircrafts"], wh.aircrafts, ["Aircraft_Registration_Code"], "Aircraft_ID")
    dates = _extend(stored["Dates"], wh.dates, ["Full_Date"], "Date_ID")
    months = _extend(stored["Months"], wh.months, ["Year", "Month_Num"], "Month_ID")
    return Warehouse(
        aircrafts=aircrafts,
        dates=dates,
        months=months,
        flight_daily=facts.flight_daily_fact(wh.daily_aggregates, dates, aircrafts),
        monthly=facts.monthly_fact(wh.monthly_aggregates, months, aircrafts),
        logbooks=facts.logbook_fact(wh.logbook_aggregates, months, aircrafts),
        daily_aggregates=wh.daily_aggregates,
        monthly_aggregates=wh.monthly_aggregates,
        logbook_aggregates=wh.logbook_aggregates,
    )


def _window() -> Column:
    return F.expr(OPEN_WINDOW)


def _late_flights(flights: DataFrame, boundary: DataFrame) -> DataFrame:
    """Flown flights that depart before the open window of their aircraft."""
    last = boundary.filter(~F.col(cleaning.SETTLED)).groupBy(F.col(facts.REG).alias("_reg")).agg(F.max(cleaning.AD).alias("_last"))
    last = bounded_broadcast(materialize(last, "boundary-ends"))
    flown = flights.filter(~F.coalesce(F.col(cleaning.CANCELLED), F.lit(False)))
    return flown.join(last, (F.col(facts.REG) == F.col("_reg")) & (F.col(cleaning.AD) < F.col("_last") - _window()), "left_semi")


def _open_keys(opened: DataFrame, dates: DataFrame, aircrafts: DataFrame) -> DataFrame:
    """Keys of the daily facts of the days that hold a boundary flight."""
    days = opened.filter(~F.col(cleaning.SETTLED) & ~F.col(cleaning.GONE)).select(day_of("scheduleddeparture").alias("Full_Date"), facts.REG).distinct()
    found = facts.resolve_keys(days, facts.flight_daily_lookups(dates, aircrafts), "inner")
    return bounded_broadcast(materialize(found.select(*facts.FLIGHT_DAILY_KEYS), "open-keys"))


def load_warehouse(src: FleetSources, path: str, clean: bool = True, reset: bool = True) -> LoadReport:
    spark = src.flights.sparkSession
    root = path.rstrip("/")
    before = None if reset else store.published(spark, root)
    boundary = before.read(spark, OPEN_FLIGHTS) if before is not None and clean and OPEN_FLIGHTS in before.folders else None
    stored: dict[str, DataFrame] = {}
    for t in schemas.WAREHOUSE_TABLES:
        if before is not None and t in before.folders:
            daily = t == "Flight_Operations_Daily"
            stored[t] = before.read(spark, t, with_period=t in FACT_TABLES, closed=daily and boundary is not None)
    absent = [t for t in DIMENSION_TABLES if t not in stored]
    if before is not None and absent:
        raise ValueError(f"the warehouse under {root} lacks {', '.join(absent)}; facts can't be appended without their dimensions")

    swapped = cleaning.swap_inverted_times(src.flights)
    judged, late = None, {}
    if clean:
        flights = swapped
        if boundary is not None:
            late["flights", "order", "departs before the open window"] = _late_flights(swapped, boundary)
            new = swapped.withColumns({cleaning.SETTLED: F.lit(False), cleaning.GONE: F.lit(False)})
            flights = new.unionByName(boundary)
        judged = cleaning.judge_overlaps(flights)
    built = build_warehouse(src, clean, judged).prepared()
    wh = _rekey(built, stored) if before is not None else built
    checks = gate(wh.tables(), stored, root, late)

    lookup = bounded_broadcast(src.aircraft)
    more: dict[str, DataFrame] = {}
    still_open = None
    if judged is not None:
        # flights removed by an earlier load were reported then
        flagged = judged.flagged.filter(~F.col(cleaning.GONE)) if boundary is not None else judged.flagged
        violations = (
            cleaning.br1_violations(src.flights)
            .unionByName(cleaning.br2_violations(swapped, flagged))
            .unionByName(cleaning.br3_violations(src.reports, lookup))
        )
        opened = materialize(cleaning.open_flights(judged, day_of("scheduleddeparture"), _window()), "boundary")
        more[OPEN_FLIGHTS] = opened
        still_open = {"Flight_Operations_Daily": _open_keys(opened, wh.dates, wh.aircrafts)}
    else:
        violations = spark.createDataFrame([], "rule string, record_id string, registration string, detail string")
    rejects = {
        "Flight_Operations_Daily": wh.rejects_flight_daily(),
        "Aircraft_Monthly_Summary": wh.rejects_monthly(),
        "Logbooks": wh.rejects_logbooks(),
    }
    more |= {"_violations": violations} | {f"_rejects_{n}": df for n, df in rejects.items()}
    now = write_warehouse(wh, root, reset=reset, more=more, still_open=still_open)
    return LoadReport(
        path=root,
        checks=checks,
        violations=now.read(spark, "_violations"),
        rejects={n: now.read(spark, f"_rejects_{n}") for n in rejects},
    )


def stored_row_counts(spark, path: str) -> DataFrame:
    """Rows per stored warehouse table: (table_name, rows)."""
    now = store.published(spark, path)
    parts = [
        now.read(spark, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in schemas.WAREHOUSE_TABLES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
