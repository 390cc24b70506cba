from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from avionyx.sources import schemas  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def pytest_collection_modifyitems(items):
    """The test that measures this process's memory goes first: later its chunks and pins would
    lie in holes of the C heap that other tests left, and no longer one after the other."""
    items.sort(key=lambda item: item.name != "test_a_task_gives_back_what_it_freed")


@pytest.fixture(scope="session")
def spark():
    from avionyx.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="avionyx-tests")
    yield s
    s.stop()


def ts(s: str | None) -> dt.datetime | None:
    return None if s is None else dt.datetime.fromisoformat(s)


def flights_df(spark, rows):
    """rows: (id, reg, sd, sa, ad, aa, cancelled, delaycode) with ISO strings."""
    data = [(i, r, ts(sd), ts(sa), ts(ad), ts(aa), c, d) for i, r, sd, sa, ad, aa, c, d in rows]
    return spark.createDataFrame(data, schemas.FLIGHTS)


def maintenance_df(spark, rows):
    data = [(r, ts(sd), ts(sa), p) for r, sd, sa, p in rows]
    return spark.createDataFrame(data, schemas.MAINTENANCE)


def reports_df(spark, rows):
    data = [(i, r, ts(d), rid, cls) for i, r, d, rid, cls in rows]
    return spark.createDataFrame(data, schemas.REPORTS)


def lookup_df(spark, rows):
    """rows: (reg, serial, model, manufacturer) in file order."""
    data = [(*r, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data,
        "aircraft_reg_code string, manufacturer_serial_number string, aircraft_model string, "
        "aircraft_manufacturer string, lookup_line long",
    )


def personnel_df(spark, rows):
    return spark.createDataFrame(rows, schemas.PERSONNEL)
