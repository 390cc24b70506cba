"""Build the star schema from the sources: clean -> dimensions -> facts.

``build_warehouse`` returns a warehouse whose tables are built when they are
first asked for, each once.  The dimensions are small compared with the facts
but not assumed tiny: each is materialized and hinted for broadcast only after
its size is measured.

Plan shape per fact: one scan of the source with pruned columns, one
shuffle for the group-by (partial aggregation map-side), then broadcast
joins to the dimensions (or shuffle joins when a dimension is too large).
The grouped rows of each fact are materialized once: the fact, its rejects and
the checks all read them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_parts
from ..operators import cleaning, dimensions, facts, integrity
from ..operators.joins import bounded_broadcast
from ..session import materialize
from ..sources import FleetSources, schemas
from . import store

T = TypeVar("T")


class ConstraintViolation(RuntimeError):
    """A load broke declared constraints; nothing was published."""


def clean_sources(src: FleetSources, clean: bool = True) -> FleetSources:
    """Q5: BR1 then BR2 on flights, BR3 on reports; maintenance is never
    cleaned.  With ``clean=False`` the sources pass through unchanged."""
    if not clean:
        return src
    flights = cleaning.drop_overlapping_flights(cleaning.swap_inverted_times(src.flights))
    reports = cleaning.valid_reports(src.reports, bounded_broadcast(src.aircraft))
    return src._replace(flights=flights, reports=reports)


class WarehouseTables:
    """The six tables by name, and the reject tables of the grouped rows."""

    def tables(self) -> dict[str, DataFrame]:
        return {
            "Aircrafts": self.aircrafts,
            "Dates": self.dates,
            "Months": self.months,
            "Flight_Operations_Daily": self.flight_daily,
            "Aircraft_Monthly_Summary": self.monthly,
            "Logbooks": self.logbooks,
        }

    # --- J4 rejects ---------------------------------------------------------

    def _need_aggregates(self) -> None:
        if "Full_Date" not in self.daily_aggregates.columns:
            raise ValueError("rejects need the grouped rows of a build; a stored warehouse does not keep them")

    def rejects_flight_daily(self) -> DataFrame:
        self._need_aggregates()
        r = facts.resolve_keys(self.daily_aggregates, facts.flight_daily_lookups(self.dates, self.aircrafts))
        return facts.rejected_rows(r, facts.FLIGHT_DAILY_KEYS, ["Full_Date", facts.REG])

    def rejects_monthly(self) -> DataFrame:
        self._need_aggregates()
        r = facts.resolve_keys(self.monthly_aggregates, facts.month_lookups(self.months, self.aircrafts))
        return facts.rejected_rows(r, facts.MONTHLY_KEYS, ["Year", "Month_Num", facts.REG])

    def rejects_logbooks(self) -> DataFrame:
        self._need_aggregates()
        r = facts.resolve_keys(self.logbook_aggregates, facts.month_lookups(self.months, self.aircrafts))
        return facts.rejected_rows(r, facts.LOGBOOK_KEYS, ["Year", "Month_Num", "Airport", facts.REG])


@dataclass(frozen=True)
class Warehouse(WarehouseTables):
    aircrafts: DataFrame
    dates: DataFrame
    months: DataFrame
    flight_daily: DataFrame
    monthly: DataFrame
    logbooks: DataFrame
    # Grouped rows before key lookup, for the reject tables.
    daily_aggregates: DataFrame
    monthly_aggregates: DataFrame
    logbook_aggregates: DataFrame


class BuiltWarehouse(WarehouseTables):
    """Tables of one build, each made when first asked for."""

    def __init__(self, src: FleetSources, clean: bool = True, judged: cleaning.JudgedFlights | None = None):
        self._raw, self._clean, self._judged = src, clean, judged

    @cached_property
    def _flights(self) -> DataFrame:
        if not self._clean:
            return self._raw.flights
        if self._judged is not None:
            return cleaning.drop_overlapping_flights(self._judged.flights, self._judged)
        return cleaning.drop_overlapping_flights(cleaning.swap_inverted_times(self._raw.flights))

    @cached_property
    def _reports(self) -> DataFrame:
        return cleaning.valid_reports(self._raw.reports, self._lookup) if self._clean else self._raw.reports

    @cached_property
    def _lookup(self) -> DataFrame:
        return bounded_broadcast(self._raw.aircraft)

    @cached_property
    def _daily_totals(self) -> DataFrame:
        """Feeds the Dates dimension and the daily fact; keeps rows of flights
        without a registration so that their days still count."""
        return materialize(facts.daily_flight_totals(self._flights, keep_null_registration=True), "daily-totals")

    @cached_property
    def aircrafts(self) -> DataFrame:
        members = dimensions.aircraft_members(self._lookup, self._reports)
        return bounded_broadcast(materialize(dimensions.aircraft_dimension(members), "dim-aircrafts"))

    @cached_property
    def dates(self) -> DataFrame:
        days = self._daily_totals.select("Full_Date").distinct().select("Full_Date", *date_parts("Full_Date"))
        return bounded_broadcast(materialize(dimensions.date_dimension(days), "dim-dates"))

    @cached_property
    def months(self) -> DataFrame:
        members = dimensions.month_members(self._reports, self._raw.maintenance)
        return bounded_broadcast(materialize(dimensions.month_dimension(members), "dim-months"))

    @cached_property
    def daily_aggregates(self) -> DataFrame:
        return facts.daily_flight_measures(self._daily_totals)

    @cached_property
    def monthly_aggregates(self) -> DataFrame:
        return materialize(facts.monthly_maintenance_aggregates(self._raw.maintenance), "monthly-totals")

    @cached_property
    def logbook_aggregates(self) -> DataFrame:
        counts = facts.logbook_aggregates(self._reports, bounded_broadcast(self._raw.personnel))
        return materialize(counts, "logbook-totals")

    @cached_property
    def flight_daily(self) -> DataFrame:
        return facts.flight_daily_fact(self.daily_aggregates, self.dates, self.aircrafts)

    @cached_property
    def monthly(self) -> DataFrame:
        return facts.monthly_fact(self.monthly_aggregates, self.months, self.aircrafts)

    @cached_property
    def logbooks(self) -> DataFrame:
        return facts.logbook_fact(self.logbook_aggregates, self.months, self.aircrafts)

    def prepared(self) -> BuiltWarehouse:
        """Materialize what all six tables need, independent parts together."""
        concurrently(
            lambda: self.dates,
            lambda: self.aircrafts,
            lambda: self.months,
            lambda: self.monthly_aggregates,
            lambda: self.logbook_aggregates,
        )
        return self


def concurrently(*jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark actions from driver threads so that their jobs
    share the executors (each job alone may have few tasks)."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def build_warehouse(src: FleetSources, clean: bool = True, judged: cleaning.JudgedFlights | None = None) -> BuiltWarehouse:
    """``judged`` are the flights as BR2 has judged them already."""
    return BuiltWarehouse(src, clean, judged)


# --- D6 / D7: loading and reusing a stored warehouse ------------------------------------

DIMENSION_TABLES = ("Aircrafts", "Dates", "Months")
FACT_TABLES = ("Flight_Operations_Daily", "Aircraft_Monthly_Summary", "Logbooks")


def primary_key(table: str) -> list[str]:
    return list(integrity.warehouse_constraints()[table].unique[0])


def with_period(table: str, fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """``fact`` with the year and month of its key (199803) as ``_period``; null
    where the dimension is not at hand."""
    dim, key = ("Dates", "Date_ID") if "Date_ID" in fact.columns else ("Months", "Month_ID")
    if dim not in dims:
        return fact.withColumn(store.PERIOD, F.lit(None).cast("int"))
    periods = dims[dim].select(key, (F.col("Year") * 100 + F.col("Month_Num")).cast("int").alias(store.PERIOD))
    return fact.join(bounded_broadcast(periods), key, "left").select(*fact.columns, store.PERIOD)


def stored_again(table: str, fact: DataFrame, stored: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Rows of ``fact`` whose primary key is among ``stored`` (read with its
    periods): only the periods of the new rows are read."""
    key = primary_key(table)
    new = with_period(table, fact, dims)
    periods = [r[0] for r in new.select(store.PERIOD).distinct().collect()]  # at most one row a month
    known = [p for p in periods if p is not None]
    asked = F.col(store.PERIOD).isin(known) if known else F.lit(False)
    if None in periods:
        asked = asked | F.col(store.PERIOD).isNull()
    return new.drop(store.PERIOD).join(stored.filter(asked).select(*key), key, "left_semi")


Named = tuple[str, str, str]  # table_name, kind, constraint_name


def gate(
    tables: dict[str, DataFrame], stored: dict[str, DataFrame], root: str | None = None, more: dict[Named, DataFrame] | None = None
) -> DataFrame:
    """Check new tables and the primary keys of their facts against the stored
    facts (read with their periods); ``more`` names further rows that must not be.

    Raises ``ConstraintViolation``, else returns the check counts.  With ``root``
    the violating rows of a refused load are written, each with the constraint it
    breaks, to a folder under it that the error names.
    """
    found = dict(more or {})
    for table in FACT_TABLES:
        if table in tables and table in stored:
            name = "+".join(primary_key(table)) + " already stored"
            found[table, "unique", name] = stored_again(table, tables[table], stored[table], tables)
    counts = integrity.check_tables(tables)
    for named, rows in found.items():
        columns = zip(("table_name", "kind", "constraint_name"), named, strict=True)
        count = rows.agg(F.count(F.lit(1)).alias("violations"))
        counts = counts.unionByName(count.select(*[F.lit(v).alias(c) for c, v in columns], "violations"))
    checks = materialize(counts, "load-checks")
    failed = checks.filter(F.col("violations") > 0).collect()  # one row per failed constraint, bounded
    if failed:
        names = ", ".join(f"{r.table_name}.{r.constraint_name}={r.violations}" for r in failed)
        broken = {(r.table_name, r.kind, r.constraint_name) for r in failed}
        kept = f"; rows kept in {_quarantine(root.rstrip('/'), tables, found, broken)}" if root else ""
        raise ConstraintViolation(f"warehouse load stopped, constraints violated: {names}{kept}")
    return checks


def _quarantine(root: str, tables: dict[str, DataFrame], found: dict[Named, DataFrame], broken: set[Named]) -> str:
    """Write the rows that break a constraint, with its name, and return the folder."""
    parts = [integrity.violating_rows(tables, broken)]
    for (table, kind, name), rows in found.items():
        if (table, kind, name) in broken:
            parts.append(integrity.named_rows(rows, table, F.array(F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name")))))
    path = f"{root}/_refused/load={uuid.uuid4().hex}"
    for part in parts:
        if part is not None:
            part.write.mode("append").parquet(path)
    return path


def _declared(name: str, df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.WAREHOUSE_TABLES[name].fields])


def _write_fact(table: str, fact: DataFrame, dims: dict[str, DataFrame], path: str) -> None:
    rows = with_period(table, _declared(table, fact), dims)
    # one or few files a period; a period with most of the rows is split
    rows.hint("rebalance", store.PERIOD).write.partitionBy(store.PERIOD).parquet(path)


def load_fact(fact: DataFrame, table: str, path: str) -> store.Published:
    """Append fact rows to the stored warehouse under ``path``, columns in
    the declared order.  Rows that break a constraint, or repeat a stored
    primary key, stop the load before anything is published.  Nothing to append
    is no load: the published version stays."""
    spark, root = fact.sparkSession, path.rstrip("/")
    before = store.published(spark, root)
    fact = materialize(fact, "fact")
    if fact.isEmpty():
        return before or store.Published(root, 0, {})
    folders = dict(before.folders) if before else {}
    dims = {t: before.read(spark, t) for t in folders if t in DIMENSION_TABLES}
    stored = {t: before.read(spark, t, with_period=True) for t in folders if t == table}
    gate({**dims, table: fact}, stored, root)
    folder = store.new_folders(root, before, [table])[table]
    _write_fact(table, fact, dims, f"{root}/{folder}")
    folders[table] = [*folders.get(table, []), folder]
    return store.publish(spark, root, before, folders)


def write_warehouse(
    wh: WarehouseTables,
    path: str,
    reset: bool = True,
    more: dict[str, DataFrame] | None = None,
    still_open: dict[str, DataFrame] | None = None,
) -> store.Published:
    """Store all six tables, and ``more`` tables of this load, as a new
    version under ``path``.  ``reset=True`` starts afresh; ``reset=False`` adds
    the facts to the stored ones and replaces the dimensions, which the caller
    extends with ``keys.ensure_dimension`` beforehand.

    ``still_open`` names keys of facts that the next load writes anew: their rows
    go to a folder of their own, in place of the one before."""
    spark, root = wh.aircrafts.sparkSession, path.rstrip("/")
    before = store.published(spark, root)
    names, opened = wh.tables(), still_open or {}
    folder = store.new_folders(root, before, [*names, *(more or {})])
    jobs: list[Callable[[], None]] = []
    written: dict[str, list[str]] = {}

    def write_plain(name: str, df: DataFrame):
        jobs.append(lambda: df.write.parquet(f"{root}/{folder[name]}"))
        written[name] = [folder[name]]

    def write_fact(name: str, df: DataFrame, to: str):
        jobs.append(lambda: _write_fact(name, df, names, f"{root}/{to}"))
        written.setdefault(name, []).append(to)

    for name, df in names.items():
        if name not in FACT_TABLES:
            write_plain(name, _declared(name, df))
        elif name in opened:
            keys = primary_key(name)
            write_fact(name, df.join(opened[name], keys, "left_anti"), folder[name])
            write_fact(name, df.join(opened[name], keys, "left_semi"), folder[name] + store.OPEN)
        else:
            write_fact(name, df, folder[name])
    for name, df in (more or {}).items():
        write_plain(name, df)
    # The writes are independent jobs; run them together.  One manifest publishes them.
    concurrently(*jobs)
    old = dict(before.folders) if before and not reset else {}
    for name in FACT_TABLES:
        earlier = [f for f in old.get(name, []) if not (name in opened and f.endswith(store.OPEN))]
        written[name] = [*earlier, *written[name]]
    return store.publish(spark, root, before, {**{n: f for n, f in old.items() if n not in written and not n.startswith("_rejects")}, **written})


def read_warehouse(spark, path: str) -> Warehouse:
    """D7 (reuse): open a stored warehouse.  Dimensions are broadcast after a
    size check; the pre-lookup aggregates are not stored and come back empty."""
    now = store.published(spark, path)
    if now is None:
        raise ValueError(f"no warehouse is published under {path}")
    t = {name: now.read(spark, name) for name in schemas.WAREHOUSE_TABLES}
    empty = spark.createDataFrame([], "x int")
    return Warehouse(
        aircrafts=bounded_broadcast(t["Aircrafts"]),
        dates=bounded_broadcast(t["Dates"]),
        months=bounded_broadcast(t["Months"]),
        flight_daily=t["Flight_Operations_Daily"],
        monthly=t["Aircraft_Monthly_Summary"],
        logbooks=t["Logbooks"],
        daily_aggregates=empty,
        monthly_aggregates=empty,
        logbook_aggregates=empty,
    )
