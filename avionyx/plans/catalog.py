"""Named queries over the test tables: ``(spark, sf_dir) -> DataFrame``.

Every query derives the fleet sources from the test tables of ``sf_dir``
(``sources.testdata``) and runs one operator or report on all of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import classify, cleaning, dimensions, facts, integrity, keys, measures
from ..operators.joins import bounded_broadcast
from ..session import materialize, scratch_path
from ..sources import load_test_sources, readers
from . import baseline, kpis, reconcile, warehouse
from .warehouse import build_warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        return fn

    return register


def _src(spark: SparkSession, sf_dir: str):
    return load_test_sources(spark, sf_dir)


def _wh(spark: SparkSession, sf_dir: str, clean: bool = True):
    return build_warehouse(_src(spark, sf_dir), clean=clean)


# --- KPI reports -------------------------------------------------------------------


@query()
def utilization(spark, sf_dir):
    return kpis.utilization(_wh(spark, sf_dir))


@query()
def utilization_uncleaned(spark, sf_dir):
    return kpis.utilization(_wh(spark, sf_dir, clean=False))


@query()
def reporting(spark, sf_dir):
    return kpis.reporting(_wh(spark, sf_dir))


@query()
def reporting_per_role(spark, sf_dir):
    return kpis.reporting_per_role(_wh(spark, sf_dir))


@query()
def utilization_baseline(spark, sf_dir):
    return baseline.as_doubles(baseline.utilization_baseline(_src(spark, sf_dir)))


@query()
def reporting_baseline(spark, sf_dir):
    return baseline.as_doubles(baseline.reporting_baseline(_src(spark, sf_dir)))


@query()
def reporting_per_role_baseline(spark, sf_dir):
    return baseline.as_doubles(baseline.reporting_per_role_baseline(_src(spark, sf_dir)))


# --- sources (S1-S5) ----------------------------------------------------------------


def _csv_round_trip(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write a derived lookup as a header CSV under the shared folder, so the
    CSV reader is exercised on data derived from the test tables."""
    path = scratch_path(spark, name)
    df.write.option("header", True).option("encoding", "UTF-8").csv(path)
    return path


@query()
def src_aircraft_lookup(spark, sf_dir):
    src = _src(spark, sf_dir)
    path = _csv_round_trip(spark, src.aircraft.drop("lookup_line"), "aircraft-lookup-csv")
    return readers.read_aircraft_lookup(spark, path).drop("lookup_line")


@query()
def src_personnel(spark, sf_dir):
    path = _csv_round_trip(spark, _src(spark, sf_dir).personnel, "personnel-csv")
    return readers.read_personnel(spark, path)


def _stored_source(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write a derived operational table, with a column the readers do not
    declare, so the readers work on a stored table."""
    path = scratch_path(spark, name)
    df.withColumn("loaded_by", F.lit("test")).write.parquet(path)
    return path


@query()
def src_flights(spark, sf_dir):
    return readers.read_flights(spark, _stored_source(spark, _src(spark, sf_dir).flights, "flights"))


@query()
def src_maintenance(spark, sf_dir):
    return readers.read_maintenance(spark, _stored_source(spark, _src(spark, sf_dir).maintenance, "maintenance"))


@query()
def src_reports(spark, sf_dir):
    return readers.read_reports(spark, _stored_source(spark, _src(spark, sf_dir).reports, "reports"))


# --- projections and measures (P1-P21) --------------------------------------------------


@query()
def date_parts(spark, sf_dir):
    f = _src(spark, sf_dir).flights
    return f.select("id", *fn.date_parts("scheduleddeparture"))


@query()
def date_dim(spark, sf_dir):
    f = _src(spark, sf_dir).flights
    return f.select("id", fn.day_of("scheduleddeparture").alias("Full_Date"))


@query()
def date_code(spark, sf_dir):
    f = _src(spark, sf_dir).flights
    return f.select("id", fn.date_code("scheduleddeparture").alias("date_code"))


@query()
def flight_measures(spark, sf_dir):
    m = measures.flight_measures(_src(spark, sf_dir).flights)
    return m.select(
        "id",
        "is_cancelled",
        fn.hours("flight_us").alias("FH"),
        "Takeoffs",
        "CFC",
        "is_delayed",
        "DFC",
        fn.minutes("delay_us").alias("TDM"),
    )


@query()
def baseline_flight_measures(spark, sf_dir):
    m = measures.baseline_flight_measures(_src(spark, sf_dir).flights)
    return m.select(
        "id",
        fn.hours("flight_us").alias("flightHours"),
        F.col("cycles").alias("flightCycles"),
        "cancellations",
        "delays",
        fn.minutes("delay_us").alias("delayedMinutes"),
    )


@query()
def maintenance_measures(spark, sf_dir):
    m = measures.maintenance_measures(_src(spark, sf_dir).maintenance)
    return m.select(
        "aircraftregistration",
        "scheduleddeparture",
        "Year",
        "Month_Num",
        fn.days("out_us").alias("pct_of_day"),
        fn.days("scheduled_us").alias("scheduled_pct"),
        fn.days("unscheduled_us").alias("unscheduled_pct"),
    )


@query()
def baseline_maintenance_measures(spark, sf_dir):
    m = measures.baseline_maintenance_measures(_src(spark, sf_dir).maintenance)
    return m.select(
        "aircraftregistration",
        "scheduleddeparture",
        fn.days("scheduled_us").alias("scheduledOutOfService"),
        fn.days("unscheduled_us").alias("unScheduledOutOfService"),
    )


@query()
def report_airport(spark, sf_dir):
    src = _src(spark, sf_dir)
    return measures.report_airport(src.reports, bounded_broadcast(src.personnel))


@query()
def classify_manufacturer(spark, sf_dir):
    src = _src(spark, sf_dir)
    r = src.reports.select("pfrid", "aircraftregistration")
    return classify.classify_manufacturer(r, src.aircraft)


@query()
def aircraft_per_manufacturer(spark, sf_dir):
    return classify.aircraft_per_manufacturer(_src(spark, sf_dir).aircraft)


# --- cleaning (Q1-Q5, W1) -------------------------------------------------------------------


def _br1(spark, sf_dir):
    return cleaning.swap_inverted_times(_src(spark, sf_dir).flights)


@query()
def br1_swap_inverted(spark, sf_dir):
    return _br1(spark, sf_dir)


@query()
def next_departure(spark, sf_dir):
    return cleaning.next_departure(_br1(spark, sf_dir))


@query()
def br2_drop_overlaps(spark, sf_dir):
    return cleaning.drop_overlapping_flights(_br1(spark, sf_dir))


@query()
def br3_valid_reports(spark, sf_dir):
    src = _src(spark, sf_dir)
    return cleaning.valid_reports(src.reports, bounded_broadcast(src.aircraft))


@query()
def br1_violations(spark, sf_dir):
    return cleaning.br1_violations(_src(spark, sf_dir).flights)


@query()
def br2_violations(spark, sf_dir):
    return cleaning.br2_violations(_br1(spark, sf_dir))


@query()
def br3_violations(spark, sf_dir):
    src = _src(spark, sf_dir)
    return cleaning.br3_violations(src.reports, bounded_broadcast(src.aircraft))


@query()
def br_violation_counts(spark, sf_dir):
    src = _src(spark, sf_dir)
    lookup = bounded_broadcast(src.aircraft)
    return cleaning.violation_counts(
        cleaning.br1_violations(src.flights),
        cleaning.br2_violations(cleaning.swap_inverted_times(src.flights)),
        cleaning.br3_violations(src.reports, lookup),
    )


# --- dimensions and keys (D1-D6) --------------------------------------------------------------


@query()
def dim_aircraft(spark, sf_dir):
    return _wh(spark, sf_dir).aircrafts


@query()
def dim_aircraft_uncleaned(spark, sf_dir):
    """D1 without BR3: registrations seen in reports only become members too."""
    return _wh(spark, sf_dir, clean=False).aircrafts


@query()
def dim_date(spark, sf_dir):
    return _wh(spark, sf_dir).dates


@query()
def dim_month(spark, sf_dir):
    return _wh(spark, sf_dir).months


@query()
def surrogate_keys(spark, sf_dir):
    """D4 on a data-dependent member set: every registration that flies."""
    regs = (
        _src(spark, sf_dir)
        .flights.select(F.col("aircraftregistration").alias("registration"))
        .filter(F.col("registration").isNotNull())
        .distinct()
    )
    return keys.assign_surrogate_keys(regs, ["registration"], "key")


@query()
def ensure_dimension(spark, sf_dir):
    """Extend the lookup-only Aircrafts dimension with the registrations
    of the raw reports; returns the rows to append."""
    src = _src(spark, sf_dir)
    existing = dimensions.aircraft_dimension(dimensions.aircraft_members(src.aircraft))
    candidates = src.reports.select(F.col("aircraftregistration").alias("Aircraft_Registration_Code")).filter(
        F.col("Aircraft_Registration_Code").isNotNull()
    )
    return keys.ensure_dimension(existing, candidates, ["Aircraft_Registration_Code"], "Aircraft_ID")


@query()
def load_fact(spark, sf_dir):
    """Append the daily fact to a stored table and read it back."""
    path = scratch_path(spark, "warehouse")
    wh = _wh(spark, sf_dir)
    now = warehouse.load_fact(wh.flight_daily, "Flight_Operations_Daily", path)
    return now.read(spark, "Flight_Operations_Daily")


# --- facts, key resolution, rejects (A1-A3, J2-J4) ---------------------------------------------


@query()
def fact_flight_daily(spark, sf_dir):
    return _wh(spark, sf_dir).flight_daily


@query()
def fact_monthly(spark, sf_dir):
    return _wh(spark, sf_dir).monthly


@query()
def fact_logbooks(spark, sf_dir):
    return _wh(spark, sf_dir).logbooks


@query()
def resolve_flight_keys(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    r = facts.resolve_keys(wh.daily_aggregates, facts.flight_daily_lookups(wh.dates, wh.aircrafts))
    return r.select("Full_Date", "aircraftregistration", "Date_ID", "Aircraft_ID")


@query()
def resolve_month_keys(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    r = facts.resolve_keys(wh.monthly_aggregates, facts.month_lookups(wh.months, wh.aircrafts))
    return r.select("Year", "Month_Num", "aircraftregistration", "Month_ID", "Aircraft_ID")


@query()
def rejects_flight_daily(spark, sf_dir):
    return _wh(spark, sf_dir).rejects_flight_daily()


@query()
def rejects_monthly(spark, sf_dir):
    return _wh(spark, sf_dir).rejects_monthly()


@query()
def rejects_logbooks(spark, sf_dir):
    return _wh(spark, sf_dir).rejects_logbooks()


@query()
def rejects_logbooks_unknown(spark, sf_dir):
    """Logbook rows of all reports against the lookup fleet alone: those of
    unknown aircraft find no key."""
    src = _src(spark, sf_dir)
    counts = facts.logbook_aggregates(src.reports, bounded_broadcast(src.personnel))
    fleet = dimensions.aircraft_dimension(dimensions.aircraft_members(src.aircraft))
    months = dimensions.month_dimension(dimensions.month_members(src.reports, src.maintenance))
    resolved = facts.resolve_keys(counts, facts.month_lookups(months, fleet))
    return facts.rejected_rows(resolved, facts.LOGBOOK_KEYS, ["Year", "Month_Num", "Airport", facts.REG])


# --- yearly totals (A4-A8) and the source-side union (U1) -----------------------------------------


@query()
def yearly_flight_totals(spark, sf_dir):
    return kpis.yearly_flight_totals(_wh(spark, sf_dir))


@query()
def yearly_maintenance_totals(spark, sf_dir):
    return kpis.yearly_maintenance_totals(_wh(spark, sf_dir))


@query()
def yearly_utilization(spark, sf_dir):
    return kpis.yearly_utilization(_wh(spark, sf_dir))


@query()
def yearly_report_totals(spark, sf_dir):
    return kpis.yearly_report_totals(_wh(spark, sf_dir))


@query()
def yearly_role_totals(spark, sf_dir):
    return kpis.yearly_role_totals(_wh(spark, sf_dir))


@query()
def utilization_events(spark, sf_dir):
    src = _src(spark, sf_dir)
    return baseline.utilization_events(src.flights, src.maintenance)


# --- reconciliation (K7) ------------------------------------------------------------------------


def _reconciled(spark, sf_dir, name):
    src = _src(spark, sf_dir)
    return reconcile.reconcile_report(name, build_warehouse(src), src)


@query()
def reconcile_utilization(spark, sf_dir):
    return _reconciled(spark, sf_dir, "utilization")


@query()
def reconcile_reporting(spark, sf_dir):
    return _reconciled(spark, sf_dir, "reporting")


@query()
def reconcile_reporting_per_role(spark, sf_dir):
    return _reconciled(spark, sf_dir, "reporting_per_role")


# --- integrity (C1-C5) ------------------------------------------------------------------------------


@query()
def check_not_null(spark, sf_dir):
    """Daily fact rows as they would be loaded, keys looked up: the NOT NULL
    keys of Flight_Operations_Daily fail where a key is unresolved."""
    wh = _wh(spark, sf_dir)
    r = facts.resolve_keys(wh.daily_aggregates, facts.flight_daily_lookups(wh.dates, wh.aircrafts))
    bad = integrity.check_not_null(r, ["Date_ID", "Aircraft_ID"])
    return bad.select("Full_Date", "aircraftregistration", "violated")


@query()
def check_unique(spark, sf_dir):
    """Flights departing twice at the same minute with the same aircraft."""
    f = _src(spark, sf_dir).flights
    return integrity.check_unique(f, ["aircraftregistration", "scheduleddeparture"])


@query()
def check_foreign_key(spark, sf_dir):
    """Flights of aircraft missing from the lookup."""
    src = _src(spark, sf_dir)
    bad = integrity.check_foreign_key(
        src.flights, ["aircraftregistration"], bounded_broadcast(src.aircraft), ["aircraft_reg_code"]
    )
    return bad.select("id", "aircraftregistration")


@query()
def check_domain(spark, sf_dir):
    """Declared CHECKs of the monthly summary on its candidate rows."""
    wh = _wh(spark, sf_dir)
    rules = integrity.warehouse_constraints()["Aircraft_Monthly_Summary"].domain
    bad = integrity.check_domain(wh.monthly_aggregates, rules)
    return bad.select("Year", "Month_Num", "aircraftregistration", "violated")


@query()
def check_length(spark, sf_dir):
    """Declared VARCHAR lengths of the Aircrafts dimension."""
    wh = _wh(spark, sf_dir)
    limits = integrity.warehouse_constraints()["Aircrafts"].length
    return integrity.check_length(wh.aircrafts, limits).select("Aircraft_ID", "violated")


@query()
def check_domain_unclipped(spark, sf_dir):
    """C4 on rows that break it: unclipped windows that end before they start."""
    m = measures.baseline_maintenance_measures(_src(spark, sf_dir).maintenance)
    rules = {"scheduled_ge_0": F.col("scheduled_us") >= 0, "unscheduled_ge_0": F.col("unscheduled_us") >= 0}
    bad = integrity.check_domain(m, rules)
    return bad.select("aircraftregistration", "scheduleddeparture", "scheduledarrival", "violated")


@query()
def check_length_registration(spark, sf_dir):
    """C5 on rows that break it: registrations of more than one character."""
    bad = integrity.check_length(_wh(spark, sf_dir).aircrafts, {"Aircraft_Registration_Code": 1})
    return bad.select("Aircraft_ID", "Aircraft_Registration_Code", "violated")


def _broken_tables(spark, sf_dir):
    """Tables that break a constraint of every kind: daily totals doubled, with
    the keys of unknown aircraft left null and the delay negated; a dimension
    that lost every third date; long registrations."""
    wh = _wh(spark, sf_dir)
    daily = facts.resolve_keys(wh.daily_aggregates, facts.flight_daily_lookups(wh.dates, wh.aircrafts))
    daily = daily.withColumn("TDM", -F.col("TDM"))
    aircrafts = wh.aircrafts.withColumn(
        "Aircraft_Registration_Code", F.concat(F.lit("0123456789"), F.col("Aircraft_Registration_Code"))
    )
    return {
        # stored, as load_fact does: the checks read it several times
        "Flight_Operations_Daily": materialize(daily.unionByName(daily), "broken-daily"),
        "Aircrafts": aircrafts,
        "Dates": wh.dates.where("Date_ID % 3 <> 0"),
    }


@query()
def warehouse_checks_violated(spark, sf_dir):
    """Counts of the gate over tables that break a constraint of every kind."""
    return integrity.check_tables(_broken_tables(spark, sf_dir))


@query()
def etl_refused(spark, sf_dir):
    """The gate refuses those tables: the rows it kept, a row for each constraint it breaks."""
    root = scratch_path(spark, "warehouse")
    try:
        warehouse.gate(_broken_tables(spark, sf_dir), {}, root)
    except warehouse.ConstraintViolation:
        rows = spark.read.option("basePath", f"{root}/_refused").parquet(f"{root}/_refused/load=*")
        keys_ = F.from_json("row", "Date_ID int, Aircraft_ID int").alias("keys")  # both in one pass over the text
        return rows.select("table_name", "kind", "constraint_name", keys_).select("table_name", "kind", "constraint_name", "keys.*")
    raise RuntimeError("the gate let broken tables pass")


@query()
def warehouse_checks(spark, sf_dir):
    """Violation counts of every declared constraint on the built warehouse."""
    return integrity.check_tables(_wh(spark, sf_dir).tables())


# --- streaming ---------------------------------------------------------------------------------------


@query()
def logbook_aggregates_stream(spark, sf_dir):
    """A3 run incrementally: the derived reports land as several parquet
    files, a Structured Streaming query folds them in (BR3 on), and the
    published counts are returned."""
    from ..streaming.incremental import logbook_counts, start_logbook_stream

    src = _src(spark, sf_dir)
    landing = scratch_path(spark, "reports-landing")
    src.reports.repartition(4).write.parquet(landing)
    out = scratch_path(spark, "logbook-counts")
    q = start_logbook_stream(
        spark,
        landing,
        bounded_broadcast(src.aircraft),
        out,
        scratch_path(spark, "logbook-stream-checkpoint"),
        files_per_batch=2,
    )
    q.awaitTermination()
    return logbook_counts(spark, out, bounded_broadcast(src.personnel))


@query()
def etl_load(spark, sf_dir):
    """The gated ETL run into a stored warehouse; rows per stored table."""
    from . import etl

    path = scratch_path(spark, "warehouse")
    etl.load_warehouse(_src(spark, sf_dir), path, clean=True, reset=True)
    return etl.stored_row_counts(spark, path)


@query()
def etl_append(spark, sf_dir):
    """E1 run twice: half of the fleet first, the other half appended.  The
    stored daily facts by natural key equal those of one load."""
    from . import etl

    src = _src(spark, sf_dir)
    reg = F.coalesce(F.col("aircraftregistration"), F.lit("0"))
    path = scratch_path(spark, "warehouse")
    for half in (0, 1):
        mine = F.pmod(F.crc32(reg.cast("binary")), F.lit(2)) == half
        part = src._replace(flights=src.flights.where(mine), maintenance=src.maintenance.where(mine), reports=src.reports.where(mine))
        etl.load_warehouse(part, path, clean=True, reset=half == 0)
    stored = warehouse.read_warehouse(spark, path)
    rows = stored.flight_daily.join(stored.dates, "Date_ID").join(stored.aircrafts, "Aircraft_ID")
    return rows.select("Full_Date", "Aircraft_Registration_Code", "FH", "Takeoffs", "DFC", "CFC", "TDM")


# Two loads by date meet on a day on which flights of the evening before still overlap.
SECOND_LOAD_FROM = "1996-06-24 00:00:00"


@query()
def br2_two_loads(spark, sf_dir):
    """Q2 across loads: the flights before and from a date, loaded one after the
    other.  The stored daily facts and the overlaps that the two loads report
    equal those of one load."""
    from . import etl

    src = _src(spark, sf_dir)
    second = F.coalesce(F.col("scheduleddeparture") >= F.lit(SECOND_LOAD_FROM).cast("timestamp_ntz"), F.lit(False))
    path = scratch_path(spark, "warehouse")
    first = etl.load_warehouse(src._replace(flights=src.flights.where(~second)), path)
    empty = F.lit(False)
    later = src._replace(flights=src.flights.where(second), maintenance=src.maintenance.where(empty), reports=src.reports.where(empty))
    found = first.violations.unionByName(etl.load_warehouse(later, path, reset=False).violations).where("rule = 'BR2'")
    stored = warehouse.read_warehouse(spark, path)
    rows = stored.flight_daily.join(stored.dates, "Date_ID").join(stored.aircrafts, "Aircraft_ID")
    measures_ = ["FH", "Takeoffs", "DFC", "CFC", "TDM"]
    kept = rows.select(
        F.lit("fact").alias("kind"), F.col("Aircraft_Registration_Code").alias("registration"), F.lit(None).cast("string").alias("record_id"), "Full_Date", *measures_
    )
    return kept.unionByName(found.select(F.lit("violation").alias("kind"), "registration", "record_id"), allowMissingColumns=True)
