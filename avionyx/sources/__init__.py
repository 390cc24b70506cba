"""Sources: declared schemas, readers and the test-table derivations."""

from . import schemas
from .readers import (
    conform,
    jdbc_options,
    read_aircraft_lookup,
    read_flights,
    read_maintenance,
    read_personnel,
    read_reports,
    read_source,
)
from .testdata import FleetSources, load_test_sources

__all__ = [
    "FleetSources",
    "conform",
    "jdbc_options",
    "load_test_sources",
    "read_aircraft_lookup",
    "read_flights",
    "read_maintenance",
    "read_personnel",
    "read_reports",
    "read_source",
    "schemas",
]
