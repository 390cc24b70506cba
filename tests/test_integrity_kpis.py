import datetime as dt

import pytest
from pyspark.sql import functions as F

from avionyx.operators import integrity
from avionyx.plans import kpis
from avionyx.plans.warehouse import Warehouse
from avionyx.sources import schemas


def _wh(spark, aircrafts, dates, months, daily, monthly, logbooks):
    mk = lambda rows, s: spark.createDataFrame(rows, s)
    empty = spark.createDataFrame([], "x int")
    return Warehouse(
        aircrafts=mk(aircrafts, schemas.AIRCRAFTS),
        dates=mk(dates, schemas.DATES),
        months=mk(months, schemas.MONTHS),
        flight_daily=mk(daily, schemas.FLIGHT_OPERATIONS_DAILY),
        monthly=mk(monthly, schemas.AIRCRAFT_MONTHLY_SUMMARY),
        logbooks=mk(logbooks, schemas.LOGBOOKS),
        daily_aggregates=empty,
        monthly_aggregates=empty,
        logbook_aggregates=empty,
    )


def test_each_check_returns_the_breaking_row(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (2, None, 5), (2, "c", -1), (3, "dddddddddddd", 5)], "k int, s string, v int"
    )
    assert [r.k for r in integrity.check_not_null(df, ["s"]).collect()] == [2]
    assert [(r.k, r.n) for r in integrity.check_unique(df, ["k"]).collect()] == [(2, 2)]
    ref = spark.createDataFrame([(1,), (2,)], "k int")
    assert [r.k for r in integrity.check_foreign_key(df, ["k"], ref).collect()] == [3]
    assert [r.k for r in integrity.check_domain(df, {"v_ge_0": F.col("v") >= 0}).collect()] == [2]
    assert [r.k for r in integrity.check_length(df, {"s": 10}).collect()] == [3]
    # a null passes a CHECK, a FK and a length limit
    nulls = spark.createDataFrame([(None, None, None)], "k int, s string, v int")
    assert integrity.check_domain(nulls, {"v_ge_0": F.col("v") >= 0}).count() == 0
    assert integrity.check_foreign_key(nulls, ["k"], ref).count() == 0


def _small_warehouse(spark, takeoffs=(4, 3), dfc=(1, 0), tdm=(40.0, 0.0)):
    aircrafts = [(1, "A1", "MSN 1", "A320", "Airbus"), (2, "A2", "MSN 2", "A320", "Airbus"), (3, "U1", None, None, None)]
    dates = [(1, dt.date(2020, 1, 1), 1, 1, 2020), (2, dt.date(2020, 1, 2), 2, 1, 2020)]
    months = [(1, 1, 2020), (2, 2, 2020)]
    daily = [
        (1, 1, 10.0, takeoffs[0], dfc[0], 0, tdm[0]),
        (2, 2, 8.0, takeoffs[1], dfc[1], 1, tdm[1]),
        (1, 3, 5.0, 1, 0, 0, 0.0),  # unknown manufacturer: never matches in the join
    ]
    monthly = [(1, 1, 29.0, 1.5, 0.5), (2, 2, 28.0, 0.5, 0.5)]
    logbooks = [(1, 1, "BCN", 3), (2, 2, "NONE", 2)]
    return _wh(spark, aircrafts, dates, months, daily, monthly, logbooks)


def test_utilization_formulas(spark):
    r = kpis.utilization(_small_warehouse(spark)).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.manufacturer, r.year) == ("Airbus", 2020)
    assert r.FH == 9.0 and r.TakeOff == 3.5  # the warehouse divides exactly: 7 take-offs / 2 aircraft
    assert r.ADOS == 1.5 and r.ADIS == 28.5
    assert r.DYR == pytest.approx(100 * 0.1429)
    assert r.CNR == pytest.approx(100 * 0.1429)
    assert r.TDR == 72.0  # ceil(100 - 28.57)
    assert r.ADD == 4000.0  # 100 x minutes per delayed flight, as the report defines it


def test_zero_takeoffs_and_zero_delays_give_null_ratios(spark):
    r = kpis.utilization(_small_warehouse(spark, takeoffs=(0, 0), dfc=(0, 0), tdm=(0.0, 0.0))).collect()[0]
    assert r.DYR is None and r.CNR is None and r.TDR is None and r.ADD is None


def test_reporting_per_role_uses_unsplit_denominators(spark):
    rows = {x.role: x for x in kpis.reporting_per_role(_small_warehouse(spark)).collect()}
    assert set(rows) == {"MAREP", "PIREP"}
    assert rows["MAREP"].RRc == pytest.approx(100 * round(3 / 7, 2))
    assert rows["PIREP"].RRh == pytest.approx(1000 * round(2 / 18, 3))


def test_baseline_truncates_integer_division(spark):
    from avionyx.functions import trunc_div

    out = spark.createDataFrame([(7, 2)], "c long, n long").select(trunc_div("c", "n").alias("t")).first().t
    assert out == 3.0


def test_reconcile_keeps_one_sided_rows(spark):
    from avionyx.plans import reconcile

    dw = spark.createDataFrame([("Airbus", 2020, 1.0, 2.0), ("Boeing", 2020, 3.0, 4.0)], "manufacturer string, year int, RRh double, RRc double")
    src = spark.createDataFrame(
        [("Airbus", "2020", 1.5, 2.0), ("XY-UNK", "2020", 9.0, 9.0)], "manufacturer string, year string, RRh double, RRc double"
    )
    rows = {r.manufacturer: r for r in reconcile.reconcile(dw, src, ["manufacturer", "year"], ("RRh", "RRc")).collect()}
    assert set(rows) == {"Airbus", "Boeing", "XY-UNK"}
    assert rows["Airbus"].RRh_diff == -0.5 and rows["Airbus"].RRc_diff == 0.0
    assert rows["Airbus"].year == "2020" and rows["Airbus"].in_warehouse and rows["Airbus"].in_sources
    assert rows["Boeing"].in_warehouse and not rows["Boeing"].in_sources and rows["Boeing"].RRh_diff is None
    assert rows["XY-UNK"].in_sources and not rows["XY-UNK"].in_warehouse


def test_check_tables_lists_every_constraint(spark):
    wh = _small_warehouse(spark)
    out = {(r.table_name, r.kind, r.constraint_name): r.violations for r in integrity.check_tables(wh.tables()).collect()}
    assert out[("Aircrafts", "domain", "Aircraft_Manufacturer_Class_enum")] == 0  # null class passes the CHECK
    assert out[("Aircraft_Monthly_Summary", "domain", "ADIS_ge_0")] == 0
    assert out[("Flight_Operations_Daily", "unique", "Date_ID+Aircraft_ID")] == 0
    assert out[("Flight_Operations_Daily", "foreign_key", "Aircraft_ID->Aircrafts")] == 0
    assert len(out) == 56


def test_reports_are_ordered(spark):
    """O1: manufacturer, then year, then role."""
    from conftest import SMOKE_DIR

    from avionyx.plans import baseline
    from avionyx.plans.warehouse import build_warehouse
    from avionyx.sources import load_test_sources

    src = load_test_sources(spark, SMOKE_DIR)
    wh = build_warehouse(src)
    for df, keys in (
        (kpis.utilization(wh), 2),
        (kpis.reporting(wh), 2),
        (kpis.reporting_per_role(wh), 3),
        (baseline.utilization_baseline(src), 2),
        (baseline.reporting_per_role_baseline(src), 3),
    ):
        got = [tuple("" if v is None else str(v) for v in r[:keys]) for r in df.collect()]
        assert got == sorted(got) and len(set(got)) == len(got)



def test_round_ratio_is_exact_on_ties(spark):
    from decimal import ROUND_HALF_UP, Decimal
    from fractions import Fraction

    from avionyx.functions import round_ratio, trunc_div

    rows = [(1005, 1000), (-1005, 1000), (1005, -1000), (2675, 1000), (1, 3), (0, 5), (7, 0), (None, 2), (9, None)]
    rows += [(9_000_000_000_000_000_005, 1000), (10**16 + 1, 2 * 10**14), (10**16 - 1, 2 * 10**14)]
    out = spark.createDataFrame(rows, "a long, b long").select("a", "b", round_ratio("a", "b", 2).alias("r"), trunc_div("a", "b").alias("t"))
    for a, b, r, t in out.collect():
        if a is None or not b:
            assert r is None and t is None
            continue
        x = Fraction(a, b)
        units = int(abs(x) * 100 + Fraction(1, 2)) * (1 if x > 0 else -1)
        assert r == Decimal(units).scaleb(-2) and t == int(x)
    assert Decimal("1.005").quantize(Decimal("0.01"), ROUND_HALF_UP) == out.first().r


def test_source_reports_on_rounding_ties_equal_exact_sql(spark):
    """Values that lie on a tie (1.005 h, 2.675 days, 0.125 reports a cycle): doubles would round them down."""
    from decimal import Decimal

    import duckdb
    import oracle_sql as o
    from conftest import flights_df, lookup_df, maintenance_df, reports_df

    from avionyx.plans import baseline
    from avionyx.sources import FleetSources

    flights = [(1, "A", "2020-01-01 08:00:00", "2020-01-01 09:00:00", "2020-01-01 08:00:00", "2020-01-01 09:00:18", False, None)]
    flights += [(i, "B", f"2020-01-0{i} 08:00:00", f"2020-01-0{i} 09:00:00", f"2020-01-0{i} 08:00:00", f"2020-01-0{i} 08:30:00", False, None) for i in range(2, 10)]
    flights += [(20, "C", "2020-01-01 08:00:00", "2020-01-01 09:00:00", "2020-01-01 08:00:00", "2020-01-01 07:59:42", False, None)]
    flights += [(30, "D", "2020-01-01 08:00:00", "2020-01-01 09:00:00", None, None, True, None)]
    maintenance = [("A", "2020-02-01 00:00:00", "2020-02-03 16:12:00", True), ("C", "2020-02-01 00:00:00", "2020-01-31 23:52:48", False)]
    reports = [(i, r, "2020-03-01 00:00:00", "1", "PIREP") for i, r in enumerate("ABBCD")]
    src = FleetSources(
        flights=flights_df(spark, flights),
        maintenance=maintenance_df(spark, maintenance),
        reports=reports_df(spark, reports),
        aircraft=lookup_df(spark, [("Z", "1", "m", "Airbus")]),
        personnel=spark.createDataFrame([("1", "CGN")], "reporteurid string, airport string"),
    )
    util = {r.manufacturer: r for r in baseline.utilization_baseline(src).collect()}
    assert util["A"].FH == Decimal("1.01") and util["C"].FH == Decimal("-0.01")
    assert util["A"].ADOSS == Decimal("2.68") and util["C"].ADOSU == Decimal("-0.01")  # 2.675 and -0.005 days
    rates = {r.manufacturer: r for r in baseline.reporting_baseline(src).collect()}
    assert rates["B"].RRc == Decimal("25.00") and rates["D"].RRc is None and rates["D"].RRh is None

    con = duckdb.connect()
    for name in ("flights", "maintenance", "reports"):
        con.register(f"{name}_frame", getattr(src, name).toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_frame")
    con.execute("CREATE TABLE aircraft_lookup AS SELECT 'Z' AS aircraft_reg_code, 'Airbus' AS aircraft_manufacturer")
    shared = [o.CLASS_OF, o.TIMED_FLIGHTS]
    for df, blocks, body in (
        (baseline.utilization_baseline(src), [o.BASELINE_EVENTS], o.baseline_utilization_select()),
        (baseline.reporting_baseline(src), [o.BASELINE_UTIL, o.baseline_reports(False)], o.baseline_rates_select("r.manufacturer, r.year")),
    ):
        want = con.execute(o.with_(*shared, *blocks, body=body)).fetchall()
        assert sorted(map(tuple, baseline.as_doubles(df).collect())) == sorted(want)
