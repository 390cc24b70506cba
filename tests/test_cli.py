import csv
import glob
import tempfile

import duckdb
import pytest
from conftest import SMOKE_DIR

import __spark_entry__ as entry_mod
from avionyx.__main__ import main, parser, source_requests
from avionyx.sources import load_test_sources

SF = "/root/testdata/sf0.1"


def _stored(src, folder):
    src.flights.write.parquet(f"{folder}/flights")
    src.maintenance.write.parquet(f"{folder}/maintenance")
    src.reports.write.parquet(f"{folder}/reports")
    src.aircraft.drop("lookup_line").coalesce(1).write.option("header", True).csv(f"{folder}/aircraft")
    src.personnel.coalesce(1).write.option("header", True).csv(f"{folder}/personnel")
    paths = [x for n in ("flights", "maintenance", "reports") for x in (f"--{n}", f"{folder}/{n}")]
    return [*paths, "--aircraft", f"{folder}/aircraft"]


def test_cli_etl_then_reports(spark, capsys):
    d = tempfile.mkdtemp(prefix="avionyx-cli-")
    common = _stored(load_test_sources(spark, SMOKE_DIR), d)
    out = f"{d}/out"
    assert main(["etl", *common, "--personnel", f"{d}/personnel", "--warehouse", f"{d}/dw"]) == 0
    assert main(["report", "--warehouse", f"{d}/dw", "--name", "utilization", "--output", out, "--preview", "3"]) == 0
    assert main(["baseline", *common, "--name", "reporting", "--output", out]) == 0
    assert main(["reconcile", *common, "--warehouse", f"{d}/dw", "--name", "reporting_per_role", "--output", out]) == 0
    read = lambda n: spark.read.option("header", True).csv(f"{out}/{n}")
    assert read("reporting_sources").count() > 0 and read("utilization_warehouse").count() > 0
    assert {"RRh_dw", "RRh_src", "RRh_diff"} <= set(read("reporting_per_role_reconciled").columns)
    said = capsys.readouterr().out
    assert "== utilization (warehouse): written whole" in said and "first 3 rows" in said and "Airbus" in said


def test_a_report_is_written_whole(spark):
    """Every row of K4 at the bench scale, against the oracle."""
    d = tempfile.mkdtemp(prefix="avionyx-cli-")
    common = _stored(load_test_sources(spark, SF), d)
    assert main(["baseline", *common, "--name", "utilization", "--output", f"{d}/out"]) == 0
    rows = []
    for part in glob.glob(f"{d}/out/utilization_sources/part-*"):
        with open(part, newline="") as f:
            rows += list(csv.DictReader(f))
    con = duckdb.connect()
    for t in ("lineitem", "orders", "events", "supplier", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(entry_mod.oracle_sql()["utilization_baseline"])
    names = [c[0] for c in res.description]
    want = [dict(zip(names, r, strict=True)) for r in res.fetchall()]
    assert len(rows) == len(want) > 700
    number = lambda v: None if v in (None, "") else round(float(v), 9)
    shape = lambda r: (r["manufacturer"], r["year"], *[number(r[n]) for n in names if n not in ("manufacturer", "year")])
    assert sorted(map(shape, rows), key=str) == sorted(map(shape, want), key=str)


def test_reader_options_per_table():
    args = ["baseline", "--aircraft", "a.csv", "--output", "o", "--format", "jdbc", "--option", "url=jdbc:x", "--option", "user=me"]
    tables = [f"--{n}-option" for n in ("flights", "maintenance", "reports")]
    a = parser().parse_args([*args, *[x for t in tables for x in (t, f"dbtable={t}")]])
    asked = source_requests(a)
    assert {o["dbtable"] for _, o in asked.values()} == set(tables)
    assert all(path is None and o["url"] == "jdbc:x" and o["user"] == "me" for path, o in asked.values())
    with pytest.raises(SystemExit, match="dbtable of its own"):
        source_requests(parser().parse_args([*args, "--option", "dbtable=one"]))
    with pytest.raises(SystemExit, match="--flights"):
        source_requests(parser().parse_args(args[:5]))
