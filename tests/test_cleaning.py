from conftest import flights_df, lookup_df, reports_df, ts

from avionyx.operators import cleaning


def test_br1_swaps_only_inverted_pairs(spark):
    f = flights_df(
        spark,
        [
            (1, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 12:00", "2020-01-01 10:00", False, None),
            (2, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 10:00", "2020-01-01 10:00", False, None),
            (3, "A", "2020-01-01 10:00", "2020-01-01 12:00", None, "2020-01-01 09:00", False, None),
            (4, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 13:00", "2020-01-01 11:00", True, None),
        ],
    )
    out = {r.id: (r.actualdeparture, r.actualarrival) for r in cleaning.swap_inverted_times(f).collect()}
    assert out[1] == (ts("2020-01-01 10:00"), ts("2020-01-01 12:00"))
    assert out[2] == (ts("2020-01-01 10:00"), ts("2020-01-01 10:00"))
    assert out[3] == (None, ts("2020-01-01 09:00"))
    assert out[4] == (ts("2020-01-01 11:00"), ts("2020-01-01 13:00"))  # cancelled flights are swapped too
    assert sorted(r.record_id for r in cleaning.br1_violations(f).collect()) == ["1", "4"]


def test_br1_is_idempotent(spark):
    f = flights_df(
        spark,
        [(1, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 12:00", "2020-01-01 10:00", False, None)],
    )
    once = cleaning.swap_inverted_times(f)
    assert sorted(once.collect()) == sorted(cleaning.swap_inverted_times(once).collect())


def test_br1_leaves_flights_without_one_of_the_times(spark):
    day = "2020-01-01 "
    times = [(a, b) for a in (None, "09:00", "10:00") for b in (None, "09:00", "10:00")]
    rows = [(i, "A", day + "08:00", day + "12:00", a and day + a, b and day + b, None, None) for i, (a, b) in enumerate(times)]
    out = {r.id: (r.actualdeparture, r.actualarrival) for r in cleaning.swap_inverted_times(flights_df(spark, rows)).collect()}
    for i, (a, b) in enumerate(times):
        swapped = (b, a) if a and b and b < a else (a, b)
        assert out[i] == tuple(x and ts(day + x) for x in swapped)


def _br2_rows():
    return [
        # A: 10-12 then 11-13 -> the first one overlaps its successor
        (1, "A", "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 10:00", "2020-01-01 12:00", False, None),
        (2, "A", "2020-01-01 11:00", "2020-01-01 13:00", "2020-01-01 11:00", "2020-01-01 13:00", False, None),
        # A: arrival equal to the next departure is not an overlap
        (3, "A", "2020-01-02 10:00", "2020-01-02 12:00", "2020-01-02 10:00", "2020-01-02 12:00", False, None),
        (4, "A", "2020-01-02 12:00", "2020-01-02 13:00", "2020-01-02 12:00", "2020-01-02 13:00", False, None),
        # the same times on another aircraft do not interact with A
        (5, "B", "2020-01-01 10:30", "2020-01-01 11:30", "2020-01-01 10:30", "2020-01-01 11:30", False, None),
        # a cancelled flight overlapping is ignored by the rule and kept
        (6, "A", "2020-01-01 10:15", "2020-01-01 10:45", "2020-01-01 10:15", "2020-01-01 10:45", True, None),
        # null registration never flagged
        (7, None, "2020-01-01 10:00", "2020-01-01 12:00", "2020-01-01 10:00", "2020-01-01 12:00", False, None),
        (8, None, "2020-01-01 11:00", "2020-01-01 13:00", "2020-01-01 11:00", "2020-01-01 13:00", False, None),
        # last A flight has no departure: sorts last, flags nothing
        (9, "A", "2020-01-03 10:00", "2020-01-03 12:00", None, None, False, None),
        # overlap across midnight (crosses the day bucket)
        (10, "C", "2020-01-01 23:00", "2020-01-02 02:00", "2020-01-01 23:00", "2020-01-02 02:00", False, None),
        (11, "C", "2020-01-02 01:00", "2020-01-02 03:00", "2020-01-02 01:00", "2020-01-02 03:00", False, None),
        # overlap across an empty day
        (12, "D", "2020-01-01 22:00", "2020-01-04 02:00", "2020-01-01 22:00", "2020-01-04 02:00", False, None),
        (13, "D", "2020-01-04 01:00", "2020-01-04 03:00", "2020-01-04 01:00", "2020-01-04 03:00", False, None),
        # a duplicated id: every row of a flagged id goes, even a cancelled one
        (1, "Z", "2020-05-01 10:00", "2020-05-01 11:00", None, None, True, None),
    ]


def test_br2_drops_the_earlier_overlapping_flight(spark):
    f = flights_df(spark, _br2_rows())
    flagged = sorted(r.record_id for r in cleaning.br2_violations(f).collect())
    assert flagged == ["1", "10", "12"]
    kept = sorted(r.id for r in cleaning.drop_overlapping_flights(f).collect())
    assert kept == [2, 3, 4, 5, 6, 7, 8, 9, 11, 13]


def test_br2_single_pass_is_stable(spark):
    f = flights_df(spark, _br2_rows())
    once = cleaning.drop_overlapping_flights(f)
    assert cleaning.overlapping_flights(once).count() == 0


def test_br2_bucket_count_does_not_change_the_result(spark, monkeypatch):
    f = flights_df(spark, _br2_rows())
    for n in (1, 3, 20):
        monkeypatch.setattr(cleaning, "MIN_BUCKETS", n)
        assert sorted(r.id for r in cleaning.overlapping_flights(f).collect()) == [1, 10, 12]


def test_br2_does_not_hang_on_exchange_reuse(spark):
    from avionyx.sources import load_test_sources

    f = cleaning.swap_inverted_times(load_test_sources(spark, "/root/testdata/sf0.01").flights)
    got = []
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got.append(sorted(map(tuple, cleaning.next_departure(f).collect()), key=str))
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
    assert got[0] == got[1]


def test_br2_hot_aircraft_is_spread_over_buckets(spark):
    """One aircraft holds every flight: range buckets still split it, and the
    chain of next departures crosses every bucket boundary correctly."""
    from pyspark.sql import functions as F

    n = 4000
    base = spark.range(n).select(
        F.col("id"),
        F.lit("HOT").alias("aircraftregistration"),
        (F.timestamp_seconds(F.col("id") * 600)).cast("timestamp_ntz").alias("actualdeparture"),
    )
    # every 7th flight runs 11 minutes, overlapping the next one (10 minutes later)
    f = base.select(
        "id",
        "aircraftregistration",
        F.col("actualdeparture").alias("scheduleddeparture"),
        F.col("actualdeparture").alias("scheduledarrival"),
        "actualdeparture",
        F.expr("actualdeparture + make_dt_interval(0, 0, CASE WHEN id % 7 = 0 THEN 11 ELSE 5 END, 0)").alias(
            "actualarrival"
        ),
        F.lit(False).alias("cancelled"),
        F.lit(None).cast("string").alias("delaycode"),
    )
    nxt = cleaning.next_departure(f, num_buckets=8)
    rows = {r.id: r.next_departure for r in nxt.collect()}
    assert len(rows) == n
    assert all(rows[i] is not None for i in range(n - 1)) and rows[n - 1] is None
    flagged = sorted(r.id for r in cleaning.overlapping_flights(f).collect())
    assert flagged == [i for i in range(n - 1) if i % 7 == 0]


def test_br3_keeps_known_registrations(spark):
    r = reports_df(
        spark,
        [
            (1, "XY-AAA", "2020-01-01 00:00", "1", "PIREP"),
            (2, "XY-ZZZ", "2020-01-01 00:00", "1", "PIREP"),
            (3, None, "2020-01-01 00:00", "1", "PIREP"),
        ],
    )
    lk = lookup_df(spark, [("XY-AAA", "MSN 1", "A320", "Airbus")])
    assert [x.pfrid for x in cleaning.valid_reports(r, lk).collect()] == [1]
    assert sorted(x.record_id for x in cleaning.br3_violations(r, lk).collect()) == ["2", "3"]
    once = cleaning.valid_reports(r, lk)
    assert once.count() == cleaning.valid_reports(once, lk).count()
