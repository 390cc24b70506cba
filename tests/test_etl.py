import os
import re
import shutil
import tempfile

import pytest
from conftest import SMOKE_DIR, flights_df, lookup_df, maintenance_df, personnel_df, reports_df
from pyspark.sql import functions as F

from avionyx.operators import cleaning
from avionyx.plans import etl, kpis, store, warehouse
from avionyx.plans.warehouse import build_warehouse, load_fact, read_warehouse
from avionyx.sources import load_test_sources
from avionyx.sources.testdata import FleetSources


@pytest.fixture(scope="module")
def loaded(spark):
    """One load of the smoke tables; tests that publish more work on a copy."""
    path = tempfile.mkdtemp(prefix="avionyx-etl-") + "/dw"
    etl.load_warehouse(load_test_sources(spark, SMOKE_DIR), path)
    return path


def test_load_then_incremental_load_keeps_keys(spark, loaded):
    src = load_test_sources(spark, SMOKE_DIR)
    path = tempfile.mkdtemp(prefix="avionyx-etl-") + "/dw"

    first = src._replace(flights=src.flights.filter("scheduleddeparture < timestamp_ntz'1998-01-01 00:00:00'"))
    report = etl.load_warehouse(first, path, clean=True, reset=True)
    assert report.checks.filter("violations > 0").count() == 0
    before = {r.Aircraft_Registration_Code: r.Aircraft_ID for r in store.read_table(spark, path, "Aircrafts").collect()}
    dates_before = store.read_table(spark, path, "Dates").count()

    later = src._replace(
        flights=src.flights.filter("scheduleddeparture >= timestamp_ntz'1998-01-01 00:00:00'"),
        maintenance=src.maintenance.filter(F.lit(False)),
        reports=src.reports.filter(F.lit(False)),
    )
    etl.load_warehouse(later, path, clean=True, reset=False)
    after = {r.Aircraft_Registration_Code: r.Aircraft_ID for r in store.read_table(spark, path, "Aircrafts").collect()}
    assert all(after[k] == v for k, v in before.items())  # existing keys kept
    assert store.read_table(spark, path, "Dates").count() > dates_before  # new days appended

    # the boundary flights of the first load are judged with the second: one load gives the same daily facts
    assert _daily(spark, path) == _daily(spark, loaded)


def _daily(spark, path):
    wh = read_warehouse(spark, path)
    rows = wh.flight_daily.join(wh.dates, "Date_ID").join(wh.aircrafts, "Aircraft_ID")
    return sorted(rows.select("Aircraft_Registration_Code", "Full_Date", *MEASURES).collect())


MEASURES = ["FH", "Takeoffs", "DFC", "CFC", "TDM"]


def _counts(spark, path):
    return {r.table_name: r.rows for r in etl.stored_row_counts(spark, path).collect()}


def test_a_repeated_append_is_refused_and_changes_nothing(spark, loaded):
    src = load_test_sources(spark, SMOKE_DIR)
    path = loaded
    before, version = _counts(spark, path), store.published(spark, path).version
    with pytest.raises(etl.ConstraintViolation, match="already stored"):
        etl.load_warehouse(src, path, reset=False)
    assert _counts(spark, path) == before and store.published(spark, path).version == version
    wh = read_warehouse(spark, path)
    with pytest.raises(etl.ConstraintViolation, match="already stored"):
        load_fact(wh.flight_daily, "Flight_Operations_Daily", path)
    # a load that can't be published leaves the stored one as it is
    stale = store.Published(path, version - 1, {})
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        store.publish(spark, path, stale, {"Dates": []})
    assert _counts(spark, path) == before


def test_facts_are_not_appended_to_a_partial_warehouse(spark, loaded):
    src = load_test_sources(spark, SMOKE_DIR)
    path = shutil.copytree(loaded, tempfile.mkdtemp(prefix="avionyx-etl-") + "/dw")
    now = store.published(spark, path)
    store.publish(spark, path, now, {t: f for t, f in now.folders.items() if t != "Dates"})
    with pytest.raises(ValueError, match="lacks Dates"):
        etl.load_warehouse(src, path, reset=False)


def test_load_is_gated_on_constraints(spark, monkeypatch):
    src = load_test_sources(spark, SMOKE_DIR)
    path = tempfile.mkdtemp(prefix="avionyx-etl-") + "/dw"
    from avionyx.operators import integrity

    real = integrity.warehouse_constraints

    def strict():
        c = real()
        c["Flight_Operations_Daily"] = c["Flight_Operations_Daily"].__class__(
            not_null=(), domain={"FH_lt_0": F.col("FH") < 0}
        )
        return c

    monkeypatch.setattr(integrity, "warehouse_constraints", strict)
    with pytest.raises(etl.ConstraintViolation, match="FH_lt_0"):
        etl.load_warehouse(src, path)


def test_stored_reports_match_in_memory(spark, loaded):
    src = load_test_sources(spark, SMOKE_DIR)
    path = loaded
    counts = {r.table_name: r.rows for r in etl.stored_row_counts(spark, path).collect()}
    assert counts["Flight_Operations_Daily"] > 0 and counts["Logbooks"] > 0
    assert sorted(kpis.reporting(read_warehouse(spark, path)).collect()) == sorted(
        kpis.reporting(build_warehouse(src)).collect()
    )


def _fleet(spark, flights):
    return FleetSources(
        flights=flights_df(spark, flights),
        maintenance=maintenance_df(spark, []),
        reports=reports_df(spark, []),
        aircraft=lookup_df(spark, [(r, "1", "M", "Airbus") for r in "ABCDE"]),
        personnel=personnel_df(spark, []),
    )


def _flight(i, reg, dep, arr, cancelled=False, day=None):
    return (i, reg, day or dep, arr, dep, arr, cancelled, None)


LOADS = [
    [
        _flight(1, "A", "2020-01-01 08:00", "2020-01-01 09:00"),
        _flight(2, "A", "2020-01-01 23:00", "2020-01-02 02:00"),  # overlaps 11 of the next load
        _flight(3, "A", "2020-01-01 12:00", "2020-01-01 13:00", cancelled=True),
        _flight(4, "B", "2020-01-01 10:00", "2020-01-01 12:00"),  # overlaps 5
        _flight(5, "B", "2020-01-01 11:00", "2020-01-01 13:00"),
        _flight(6, "C", "2020-01-01 20:00", "2020-01-01 23:50"),  # 13 comes between 6 and 7
        _flight(7, "C", "2020-01-02 03:00", "2020-01-02 04:00", day="2020-01-01 23:59"),
        _flight(8, "D", "2020-01-01 22:00", "2020-01-05 22:00"),  # overlaps 15, two loads later
        _flight(9, "E", "2020-01-01 09:00", "2020-01-01 12:00"),  # the only flight of its day, overlaps 17
    ],
    [
        _flight(11, "A", "2020-01-02 01:00", "2020-01-02 03:00"),
        _flight(12, "A", "2020-01-02 05:00", "2020-01-02 06:00"),
        _flight(13, "C", "2020-01-01 23:40", "2020-01-02 03:30", day="2020-01-02 00:00"),  # overlaps 7 of the first load
        _flight(17, "E", "2020-01-02 10:00", "2020-01-02 11:00", day="2020-01-02 10:00"),
        (18, "E", "2020-01-02 11:30", "2020-01-02 12:00", "2020-01-01 11:30", "2020-01-02 12:00", False, None),
    ],
    [_flight(15, "D", "2020-01-04 01:00", "2020-01-04 02:00"), _flight(16, "A", "2020-01-06 05:00", "2020-01-06 06:00")],
]


def test_flights_in_three_loads_are_cleaned_as_in_one(spark):
    path = tempfile.mkdtemp(prefix="avionyx-etl-") + "/dw"
    found = []
    for i, part in enumerate(LOADS):
        report = etl.load_warehouse(_fleet(spark, part), path, reset=i == 0)
        found += [tuple(r) for r in report.violations.collect()]
    # the boundary moves on with an aircraft's flights and does not grow with its history
    assert sorted(r.id for r in store.read_table(spark, path, etl.OPEN_FLIGHTS).where("aircraftregistration = 'A'").collect()) == [11, 12, 16]
    src = _fleet(spark, [f for part in LOADS for f in part])
    swapped = cleaning.swap_inverted_times(src.flights)
    assert sorted(found) == sorted(tuple(r) for r in cleaning.br2_violations(swapped).collect())
    assert {r[1] for r in found} >= {"2", "4", "8", "13"}
    one = build_warehouse(src)
    rows = one.flight_daily.join(one.dates, "Date_ID").join(one.aircrafts, "Aircraft_ID")
    assert _daily(spark, path) == sorted(rows.select("Aircraft_Registration_Code", "Full_Date", *MEASURES).collect())
    # a flight that departs before the open window of its aircraft comes too late; another aircraft's history may
    old = _flight(2, "A", "2019-01-01 08:00", "2019-01-01 09:00"), _flight(3, "new", "2019-01-01 08:00", "2019-01-01 09:00")
    with pytest.raises(etl.ConstraintViolation, match="departs before the open window=1"):
        etl.load_warehouse(_fleet(spark, old), path, reset=False)


def test_a_crashed_publish_blocks_no_later_load(spark):
    path = tempfile.mkdtemp(prefix="avionyx-etl-") + "/dw"
    fact = build_warehouse(load_test_sources(spark, SMOKE_DIR)).flight_daily
    first = load_fact(fact.where("Date_ID % 2 = 0"), "Flight_Operations_Daily", path)
    for torn in ("", '{"folders": {"Flight_Operations_Daily": []', '{"folders": {}}'):
        number = (store.published(spark, path).highest) + 1
        with open(f"{path}/_manifest/{number}.json", "w") as f:
            f.write(torn)
        assert store.published(spark, path) == first  # passed over
    second = load_fact(fact.where("Date_ID % 2 = 1"), "Flight_Operations_Daily", path)
    assert second.version == 5 and os.path.exists(f"{path}/_manifest/5.json")
    assert store.read_table(spark, path, "Flight_Operations_Daily").count() == fact.count()
    # two loads that start from one version: the second is refused
    store.publish(spark, path, second, {"x": []})
    with pytest.raises(store.AlreadyPublished):
        store.publish(spark, path, second, {"x": []})
    with pytest.raises(store.AlreadyPublished):
        store.publish(spark, path, None, {"x": []})


def test_an_empty_append_publishes_nothing(spark):
    path = tempfile.mkdtemp(prefix="avionyx-etl-") + "/dw"
    fact = build_warehouse(load_test_sources(spark, SMOKE_DIR)).flight_daily
    assert load_fact(fact.limit(0), "Flight_Operations_Daily", path).version == 0
    assert store.published(spark, path) is None
    first = load_fact(fact, "Flight_Operations_Daily", path)
    assert load_fact(fact.limit(0), "Flight_Operations_Daily", path) == first == store.published(spark, path)


def test_refused_rows_are_kept(spark, loaded):
    path = shutil.copytree(loaded, tempfile.mkdtemp(prefix="avionyx-etl-") + "/dw")
    wh = read_warehouse(spark, path)
    again = wh.flight_daily.limit(5).withColumn("TDM", F.lit(-1.0))
    with pytest.raises(etl.ConstraintViolation, match="rows kept in") as refused:
        load_fact(again, "Flight_Operations_Daily", path)
    kept = spark.read.parquet(str(refused.value).rsplit("rows kept in ", 1)[1])
    assert {(r.constraint_name, r.n) for r in kept.groupBy("constraint_name").agg(F.count("*").alias("n")).collect()} == {
        ("TDM_ge_0", 5),
        ("Date_ID+Aircraft_ID already stored", 5),
    }


def test_gate_reads_only_the_periods_of_the_new_rows(spark, loaded):
    now = store.published(spark, loaded)
    dims = {t: now.read(spark, t) for t in warehouse.DIMENSION_TABLES}
    name = "Flight_Operations_Daily"
    stored = now.read(spark, name, with_period=True)
    month = warehouse.with_period(name, now.read(spark, name), dims).where("_period = 199603").drop("_period")
    again = warehouse.stored_again(name, month, stored, dims)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_period#\d+ = 199603", plan)
    assert again.count() == month.count() > 0
    assert stored.select("_period").distinct().count() > 12
