import os
import tempfile

import duckdb
import pytest
from conftest import SMOKE_DIR

import __spark_entry__ as entry_mod
from avionyx.plans.warehouse import build_warehouse, read_warehouse, write_warehouse
from avionyx.sources import jdbc_options, load_test_sources, read_aircraft_lookup, read_flights, read_personnel
from tools.check_oracle import digest

TABLES = ["lineitem", "orders", "events", "supplier", "customer"]


def test_first_line_wins_over_several_files_at_any_parallelism(spark):
    from avionyx.operators.dimensions import aircraft_members

    d = tempfile.mkdtemp(prefix="avionyx-lookup-")
    first_seen, header = {}, "aircraft_reg_code,manufacturer_serial_number,aircraft_model,aircraft_manufacturer\n"
    # a long and a short file before a middling one: Spark packs the largest first
    for name, lines in (("a", 300), ("b", 5), ("c", 80)):
        with open(os.path.join(d, f"{name}.csv"), "w", encoding="utf-8") as fh:
            fh.write(header)
            for i in range(lines):
                reg, serial = f"R{(i * 7) % 120}", f"{name}{i:04d}"
                fh.write(f"{reg},{serial},737,Boeing\n")
                first_seen.setdefault(reg, serial)
    set_before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for most, opening in (("128m", "4m"), ("1000", "0"), ("300", "0")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            spark.conf.set("spark.sql.files.openCostInBytes", opening)
            lookup = read_aircraft_lookup(spark, d)
            won = {r.Aircraft_Registration_Code: r.Manufacturer_Serial_Number for r in aircraft_members(lookup).collect()}
            assert won == first_seen
            ordered = [r.manufacturer_serial_number for r in lookup.orderBy("lookup_line").collect()]
            assert ordered == sorted(ordered) and len(ordered) == 385
    finally:
        for k, v in set_before.items():
            spark.conf.set(k, v)


def test_csv_lookup_reader(spark):
    d = tempfile.mkdtemp(prefix="avionyx-csv-")
    p = os.path.join(d, "lookup.csv")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("aircraft_reg_code,manufacturer_serial_number,aircraft_model,aircraft_manufacturer\n")
        fh.write("XY-ILS,MSN 1611,A350 XWB,Airbus\nXY-LBU,MSN 6147,737,Boeing\n")
    rows = read_aircraft_lookup(spark, p).orderBy("lookup_line").collect()
    assert [r.aircraft_reg_code for r in rows] == ["XY-ILS", "XY-LBU"]
    assert rows[0].aircraft_model == "A350 XWB"
    q = os.path.join(d, "personnel.csv")
    with open(q, "w", encoding="utf-8") as fh:
        fh.write("reporteurid,airport\n5137,CGN\n0042,TZL\n")
    assert [r.reporteurid for r in read_personnel(spark, q).collect()] == ["5137", "0042"]  # text, zeros kept


def test_parquet_source_reader_projects_declared_columns(spark):
    src = load_test_sources(spark, SMOKE_DIR)
    d = tempfile.mkdtemp(prefix="avionyx-src-")
    src.flights.withColumn("extra", src.flights.id).write.parquet(d + "/flights")
    back = read_flights(spark, d + "/flights")
    assert back.columns == [f.name for f in read_flights(spark, d + "/flights").schema.fields]
    assert "extra" not in back.columns
    assert back.count() == src.flights.count()


def test_jdbc_options_are_partitioned():
    o = jdbc_options("jdbc:postgresql://db/x", "flights", "u", "p", "id", 1, 100, 8)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["manufacturer", "year"]


def test_warehouse_round_trip(spark):
    src = load_test_sources(spark, SMOKE_DIR)
    wh = build_warehouse(src)
    d = tempfile.mkdtemp(prefix="avionyx-wh-")
    write_warehouse(wh, d)
    back = read_warehouse(spark, d)
    from avionyx.plans import kpis

    assert sorted(kpis.utilization(back).collect()) == sorted(kpis.utilization(wh).collect())
    # loaded + rejected = aggregated
    assert wh.flight_daily.count() + wh.rejects_flight_daily().count() == wh.daily_aggregates.count()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


ORACLE_SAMPLE = [
    "utilization",
    "reporting_per_role",
    "utilization_baseline",
    "reporting_baseline",
    "br2_drop_overlaps",
    "next_departure",
    "fact_monthly",
    "dim_aircraft",
    "surrogate_keys",
    "ensure_dimension",
    "warehouse_checks",
    "reconcile_reporting",
]


@pytest.mark.parametrize("name", ORACLE_SAMPLE)
def test_matches_duckdb_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SMOKE_DIR)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_a_missing_column_is_an_error_and_text_ids_stay(spark):
    import pytest

    from avionyx.sources import readers
    from avionyx.session import scratch_path

    src = load_test_sources(spark, SMOKE_DIR)
    path = scratch_path(spark, "flights-without")
    src.flights.drop("actualdeparture").limit(5).write.parquet(path)
    with pytest.raises(readers.MissingColumns, match="actualdeparture"):
        readers.read_flights(spark, path)
    path = scratch_path(spark, "flights-text-id")
    src.flights.limit(5).selectExpr("concat('F-', id) AS id", "* EXCEPT (id)").write.parquet(path)
    got = readers.read_flights(spark, path)
    assert dict(got.dtypes)["id"] == "string"
    assert all(r.id.startswith("F-") for r in got.collect())
