"""Plan-shape checks: the properties the design relies on at scale."""

import re

from conftest import SMOKE_DIR
from pyspark.sql import functions as F

from avionyx.operators import cleaning, facts
from avionyx.plans import baseline, catalog, etl, kpis
from avionyx.plans.warehouse import build_warehouse
from avionyx.sources import load_test_sources


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    """The adaptive plan after execution, without its "Initial Plan" section."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_no_python_in_any_report(spark):
    src = load_test_sources(spark, SMOKE_DIR)
    wh = build_warehouse(src)
    for df in (kpis.utilization(wh), kpis.reporting_per_role(wh), baseline.utilization_baseline(src)):
        p = _plan(df)
        assert "PythonUDF" not in p and "EvalPython" not in p and "ArrowEvalPython" not in p


def test_star_joins_broadcast_the_dimensions(spark):
    wh = build_warehouse(load_test_sources(spark, SMOKE_DIR))
    p = _final_plan(kpis.utilization(wh))
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p


def test_overlap_window_is_bucketed_and_reads_stored_buckets(spark):
    flights = cleaning.swap_inverted_times(load_test_sources(spark, SMOKE_DIR).flights)
    p = _final_plan(cleaning.overlapping_flights(flights))
    # the window over flights is partitioned by (bucket, registration), never by registration alone
    parts = re.findall(r"windowspecdefinition\(([^,]+), ([^,]+), actualdeparture", p)
    assert parts and all("_bucket" in a + b for a, b in parts)
    # the buckets are a stored column: no range partitioning is left to run twice
    assert "rangepartitioning" not in p and "_bucket" in p


def test_classes_are_joined_to_sums_not_to_raw_rows(spark):
    src = load_test_sources(spark, SMOKE_DIR)
    for df in (baseline.utilization_baseline(src), baseline.reporting_per_role_baseline(src)):
        p = _plan(df)
        joins = [len(x) - len(x.lstrip(" :+-")) for x in p.splitlines() if "Join" in x and "LeftOuter" in x]
        sums = [len(x) - len(x.lstrip(" :+-")) for x in p.splitlines() if "HashAggregate" in x]
        # an aggregation lies below every class join
        assert joins and all(any(s > j for s in sums) for j in joins)


def test_broadcast_check_moves_sums_only(spark):
    from avionyx.operators import joins

    df = load_test_sources(spark, SMOKE_DIR).aircraft
    n, size = joins.measured_size(df)
    assert n == df.count() and size > 16 * n
    assert joins.bounded_broadcast(df, max_bytes=size - 1) is df
    assert joins.bounded_broadcast(df, max_rows=n - 1) is df
    assert joins.bounded_broadcast(df, max_rows=n, max_bytes=size) is not df


def test_scans_are_pruned(spark):
    src = load_test_sources(spark, SMOKE_DIR)
    p = _plan(baseline.reporting_baseline(src))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas
    assert all("props" not in s and "l_extendedprice" not in s and "o_totalprice" not in s for s in schemas)


def test_fact_key_lookups_broadcast_the_dimensions(spark):
    wh = build_warehouse(load_test_sources(spark, SMOKE_DIR))
    for fact in (wh.flight_daily, wh.monthly, wh.logbooks):
        p = _final_plan(fact)
        assert "BroadcastHashJoin" in p
        assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p


def test_overlap_removal_moves_no_whole_row_by_id(spark):
    from avionyx.session import BROADCAST_ROWS_CONF

    flights = cleaning.swap_inverted_times(load_test_sources(spark, SMOKE_DIR).flights)
    again = flights.limit(40).withColumns({"cancelled": F.lit(True)})  # ids that occur twice
    for rows in (flights, flights.unionByName(again)):
        judged = cleaning.judge_overlaps(rows)
        assert (judged.shared is None) == (rows is flights)
        p = _final_plan(cleaning.drop_overlapping_flights(rows, judged))
        assert "hashpartitioning(id" not in p and "rangepartitioning" not in p
        assert ("Join" in p) == (rows is not flights)
    # beyond the broadcast bound the ids that occur twice meet the rows by a shuffle
    spark.conf.set(BROADCAST_ROWS_CONF, "0")
    try:
        assert cleaning.drop_overlapping_flights(rows).count() == cleaning.drop_overlapping_flights(rows, judged).count()
    finally:
        spark.conf.unset(BROADCAST_ROWS_CONF)


JIT_LIMIT = 8000  # bytes of a method that HotSpot still compiles


def _largest_method(spark, df) -> int:
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan holds no code before it runs
    try:
        stages = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
        return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_filters_on_swapped_flights_stay_small_enough_to_be_compiled(spark):
    flights = cleaning.swap_inverted_times(load_test_sources(spark, SMOKE_DIR).flights)
    flown = flights.filter(cleaning._is_flown())
    rest = flights.filter(~cleaning._is_flown())
    known = flights.select("aircraftregistration", F.col("scheduleddeparture").alias("_last")).limit(5)
    late = etl._late_flights(flights, known.select("aircraftregistration", F.col("_last").alias("actualdeparture"), F.lit(False).alias(cleaning.SETTLED)))
    for df in (flown, flown.select("id", "actualdeparture"), rest, late, facts.daily_flight_totals(flown.unionByName(rest))):
        assert 0 < _largest_method(spark, df) < JIT_LIMIT


def test_checks_read_the_broken_facts_from_one_stored_table(spark):
    broken = catalog._broken_tables(spark, SMOKE_DIR)["Flight_Operations_Daily"]
    p = _plan(broken)
    assert "Scan parquet" in p and "Join" not in p and "Union" not in p
    assert all(r["count"] == 2 for r in broken.groupBy("Date_ID", "Full_Date", "aircraftregistration").count().collect())


def test_refused_rows_are_parsed_once(spark):
    out = catalog.etl_refused(spark, SMOKE_DIR)
    p = _plan(out)
    assert p.count("from_json(") == 1 and "get_json_object" not in p
    assert dict(out.dtypes) == {"table_name": "string", "kind": "string", "constraint_name": "string", "Date_ID": "int", "Aircraft_ID": "int"}
    # rows of a table without dates have no Date_ID, those of an unknown aircraft no Aircraft_ID
    assert out.where("table_name = 'Aircrafts' and Date_ID is null and Aircraft_ID is not null").count() > 0
    assert out.where("constraint_name = 'Aircraft_ID' and kind = 'not_null'").where("Aircraft_ID is not null or Date_ID is null").count() == 0
