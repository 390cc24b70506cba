"""Command line: run the ETL into a warehouse folder, then write the reports.

    python -m avionyx etl --flights F --maintenance M --reports R \\
        --aircraft lookup.csv --personnel personnel.csv --warehouse DIR [--no-clean] [--append]
    python -m avionyx report --warehouse DIR --output OUT [--name utilization|reporting|reporting_per_role]
    python -m avionyx baseline --flights F --maintenance M --reports R --aircraft lookup.csv --output OUT
    python -m avionyx reconcile --warehouse DIR --flights F --maintenance M --reports R \\
        --aircraft lookup.csv --output OUT

Every report is written whole as CSV under ``--output``; ``--preview N`` also
prints its first N rows.  Operational tables are read with ``--format``
(parquet by default; any Spark source).  ``--option key=value`` goes to all
three, ``--flights-option``, ``--maintenance-option`` and ``--reports-option``
to one, for example ``--format jdbc --option url=... --flights-option
dbtable=flights``; a table read by options alone needs no path.  Under
spark-submit the cluster's session settings apply; run with plain ``python`` it
starts a local session.  Intermediate tables are deleted at the end.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import baseline, etl, kpis, reconcile
from .plans.warehouse import read_warehouse
from .session import checkpoint_dir, clear_scratch
from .sources import (
    FleetSources,
    read_aircraft_lookup,
    read_flights,
    read_maintenance,
    read_personnel,
    read_reports,
)

REPORTS = ("utilization", "reporting", "reporting_per_role")


def _session() -> SparkSession:
    """The active session, or one built from the spark-submit / default
    settings; the shared checkpoint folder is required unless local."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("avionyx").getOrCreate()
    checkpoint_dir(spark)
    return spark


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        key, _, value = p.partition("=")
        out[key] = value
    return out


OPERATIONAL = ("flights", "maintenance", "reports")


def source_requests(a: argparse.Namespace) -> dict[str, tuple[str | None, dict[str, str]]]:
    """Path and reader options of each operational table."""
    shared = _options(a.option)
    out = {}
    for name in OPERATIONAL:
        path, options = getattr(a, name), shared | _options(getattr(a, f"{name}_option"))
        if path is None and not options:
            raise SystemExit(f"--{name} PATH or --{name}-option KEY=VALUE is needed")
        out[name] = (path, options)
    tables = [o["dbtable"] for _, o in out.values() if "dbtable" in o]
    if len(set(tables)) < len(tables):
        raise SystemExit("each table needs a dbtable of its own: --flights-option dbtable=... and so on")
    return out


def _sources(spark: SparkSession, a: argparse.Namespace) -> FleetSources:
    asked = source_requests(a)
    read = {"flights": read_flights, "maintenance": read_maintenance, "reports": read_reports}
    personnel = read_personnel(spark, a.personnel) if getattr(a, "personnel", None) else None
    return FleetSources(
        **{n: read[n](spark, path, a.format, options) for n, (path, options) in asked.items()},
        aircraft=read_aircraft_lookup(spark, a.aircraft),
        personnel=personnel,
    )


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m avionyx")
    sub = p.add_subparsers(dest="cmd", required=True)
    etl_cmd, report, base, both = (sub.add_parser(n) for n in ("etl", "report", "baseline", "reconcile"))
    for s in (etl_cmd, base, both):
        for name in OPERATIONAL:
            s.add_argument(f"--{name}")
            s.add_argument(f"--{name}-option", action="append", help="reader option key=value of this table (repeatable)")
        s.add_argument("--aircraft", required=True)
        s.add_argument("--format", default="parquet")
        s.add_argument("--option", action="append", help="reader option key=value of all three tables (repeatable)")
    etl_cmd.add_argument("--personnel", required=True)
    etl_cmd.add_argument("--no-clean", action="store_true")
    etl_cmd.add_argument("--append", action="store_true", help="extend the stored dimensions and append facts")
    for s in (etl_cmd, report, both):
        s.add_argument("--warehouse", required=True)
    for s in (report, base, both):
        s.add_argument("--name", choices=REPORTS, default=None)
        s.add_argument("--output", required=True, help="folder for the whole reports, as CSV")
        s.add_argument("--preview", type=int, default=0, help="print this many first rows too")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)

    def emit(label: str, name: str, df) -> None:
        path = f"{a.output.rstrip('/')}/{name}_{label}"
        df.write.mode("overwrite").option("header", True).csv(path)
        print(f"== {name} ({label}): written whole to {path} ==")
        if a.preview:
            print(f"first {a.preview} rows:")
            df.show(a.preview, truncate=False)

    spark = _session()
    names = [a.name] if getattr(a, "name", None) else REPORTS
    if a.cmd == "etl":
        report = etl.load_warehouse(_sources(spark, a), a.warehouse, clean=not a.no_clean, reset=not a.append)
        report.violations.groupBy("rule").count().show()
        for table, rejects in report.rejects.items():
            print(f"{table}: {rejects.count()} grouped rows rejected (no dimension key)")
        etl.stored_row_counts(spark, a.warehouse).show()
    elif a.cmd == "report":
        wh = read_warehouse(spark, a.warehouse)
        for name in names:
            emit("warehouse", name, getattr(kpis, name)(wh))
    elif a.cmd == "baseline":
        src = _sources(spark, a)
        for name in names:
            emit("sources", name, getattr(baseline, f"{name}_baseline")(src))
    else:
        src, wh = _sources(spark, a), read_warehouse(spark, a.warehouse)
        for name in names:
            emit("reconciled", name, reconcile.reconcile_report(name, wh, src))
    clear_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
