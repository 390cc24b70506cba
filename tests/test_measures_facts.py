import datetime as dt

import pytest
from conftest import flights_df, maintenance_df, personnel_df, reports_df

from avionyx.operators import facts, measures


def test_flight_measures_edge_rows(spark):
    f = flights_df(
        spark,
        [
            # cancelled
            (1, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 10:00", "2020-01-01 12:00", True, None),
            # no departure -> counts as cancelled, FH 0
            (2, "A", "2020-01-01 10:00", "2020-01-01 12:00", None, None, False, None),
            # no arrival -> FH 0 but a take-off
            (3, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 10:00", None, False, "D"),
            # delay exactly 15 minutes -> not delayed
            (4, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 10:00", "2020-01-01 12:15", False, "D"),
            # 15 min 1 s -> delayed, full minutes counted
            (5, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 10:00", "2020-01-01 12:15:01", False, "D"),
            # late without a delay code -> not delayed
            (6, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 10:00", "2020-01-01 13:00", False, None),
            # cancelled, late and coded -> counted in CFC and DFC
            (7, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 10:00", "2020-01-01 13:00", True, "D"),
        ],
    )
    m = {r.id: r for r in measures.flight_measures(f).collect()}
    assert (m[1].is_cancelled, m[1].flight_us, m[1].Takeoffs, m[1].CFC) == (True, 0, 0, 1)
    assert (m[2].is_cancelled, m[2].flight_us, m[2].Takeoffs) == (True, 0, 0)
    assert (m[3].is_cancelled, m[3].flight_us, m[3].Takeoffs, m[3].DFC) == (False, 0, 1, 0)
    assert m[4].DFC == 0 and m[4].delay_us == 0
    assert m[5].DFC == 1 and m[5].delay_us == (15 * 60 + 1) * 1_000_000
    assert m[6].DFC == 0
    assert (m[7].CFC, m[7].DFC, m[7].delay_us) == (1, 1, 3600 * 1_000_000)

    b = {r.id: r for r in measures.baseline_flight_measures(f).collect()}
    assert b[3].flight_us is None  # source side: unknown arrival gives a null measure
    assert b[6].delays == 1  # source side: no delay code needed
    assert (b[7].cycles, b[7].cancellations, b[7].delays) == (0, 1, 0)


def test_daily_tdm_is_rounded_half_to_even(spark):
    rows = []
    # daily delay totals of 15.5, 16.5 and 20.5 minutes on three days
    for day, mins in (("2020-01-01", 15.5), ("2020-01-02", 16.5), ("2020-01-03", 20.5)):
        arr = dt.datetime.fromisoformat(f"{day} 12:00") + dt.timedelta(minutes=mins)
        rows.append((len(rows), "A", f"{day} 10:00", f"{day} 12:00", f"{day} 10:00", arr.isoformat(), False, "D"))
    out = {r.Full_Date.isoformat(): r.TDM for r in facts.daily_flight_aggregates(flights_df(spark, rows)).collect()}
    assert out == {"2020-01-01": 16.0, "2020-01-02": 16.0, "2020-01-03": 20.0}


def test_maintenance_fraction_clip_and_split(spark):
    m = maintenance_df(
        spark,
        [
            ("A", "2020-01-10 00:00", "2020-01-11 12:00", True),  # 36 h -> 1.0
            ("A", "2020-01-12 00:00", "2020-01-11 23:00", True),  # -1 h -> 0.0
            ("A", "2020-01-31 20:00", "2020-02-01 02:00", False),  # 6 h crossing the month -> 0.25 in January
            (None, "2020-01-15 00:00", "2020-01-16 00:00", True),  # dropped
            ("A", None, "2020-01-16 00:00", True),  # dropped
            ("A", "2020-01-20 00:00", "2020-01-20 06:00", None),  # null programmed -> unscheduled
        ],
    )
    rows = measures.maintenance_measures(m).collect()
    assert len(rows) == 4
    agg = facts.monthly_maintenance_aggregates(m).collect()
    assert len(agg) == 1
    r = agg[0]
    assert (r.Year, r.Month_Num) == (2020, 1)
    assert r.ADOSS == pytest.approx(1.0)
    assert r.ADOSU == pytest.approx(0.5)
    assert r.ADIS == pytest.approx(31 - 1.5)


def test_leap_february_and_negative_adis(spark):
    rows = [("A", f"2020-02-{d:02d} 00:00", f"2020-02-{d:02d} 23:59", True) for d in range(1, 30)]
    rows += [("A", "2020-02-01 00:00", "2020-02-02 00:00", False)]  # one more day than February holds
    agg = facts.monthly_maintenance_aggregates(maintenance_df(spark, rows)).collect()[0]
    assert agg.ADIS < 0  # more out-of-service than days: the domain check reports it

    from avionyx.operators import integrity

    bad = integrity.check_domain(
        facts.monthly_maintenance_aggregates(maintenance_df(spark, rows)),
        integrity.warehouse_constraints()["Aircraft_Monthly_Summary"].domain,
    ).collect()
    assert [b.violated for b in bad] == ["ADIS_ge_0"]

    feb = facts.monthly_maintenance_aggregates(
        maintenance_df(spark, [("A", "2020-02-03 00:00", "2020-02-03 00:00", True)])
    ).collect()[0]
    assert feb.ADIS == pytest.approx(29.0)


def test_logbook_airports(spark):
    r = reports_df(
        spark,
        [
            (1, "A", "2020-01-05 00:00", "10", "MAREP"),  # in the file
            (2, "A", "2020-01-06 00:00", "99", "PIREP"),  # not in the file -> NONE
            (3, "A", "2020-01-07 00:00", None, "PIREP"),  # null reporter -> NONE
            (4, None, "2020-01-08 00:00", "10", "MAREP"),  # no registration -> not counted
        ],
    )
    p = personnel_df(spark, [("10", "BCN")])
    out = sorted((x.Airport, x.Log_Count) for x in facts.logbook_aggregates(r, p).collect())
    assert out == [("BCN", 1), ("NONE", 2)]
    role = {x.airport: x for x in measures.report_airport(r, p).collect()}
    assert set(role) == {"BCN", "NONE"}
