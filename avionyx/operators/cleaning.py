"""Business-rule cleaning of the sources, with the violations kept as tables.

BR1  swap actual departure and arrival when the arrival comes first;
BR2  drop the earlier of two overlapping flights of the same aircraft;
BR3  keep only reports about aircraft in the lookup.

Each rule returns the cleaned frame; ``*_violations`` return what the rule
found, as rows of (rule, record_id, registration, detail).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import bounded_broadcast

ID, REG = "id", "aircraftregistration"
AD, AA = "actualdeparture", "actualarrival"
CANCELLED = "cancelled"

VIOLATION_COLUMNS = ("rule", "record_id", "registration", "detail")


def _inverted(dep: str = AD, arr: str = AA) -> Column:
    return F.col(arr).isNotNull() & F.col(dep).isNotNull() & (F.col(arr) < F.col(dep))


# --- BR1 ---------------------------------------------------------------------


def swap_inverted_times(flights: DataFrame, dep: str = AD, arr: str = AA) -> DataFrame:
    """BR1: where both times are set and arrival < departure, swap them.

    Applies to cancelled flights too and keeps every row.  Both new columns
    are computed from the original values in one projection.  Spark pushes later
    filters below it and repeats the columns there in full, so each names a time
    three times only (``least`` and ``greatest`` pass over a null): code that
    outgrows the JIT's limit for a method runs interpreted.
    """
    d, a = F.col(dep), F.col(arr)
    swapped = {dep: F.when(d.isNotNull(), F.least(d, a)), arr: F.when(a.isNotNull(), F.greatest(d, a))}
    return flights.select(*[swapped[c].alias(c) if c in swapped else F.col(c) for c in flights.columns])


def br1_violations(flights: DataFrame, dep: str = AD, arr: str = AA) -> DataFrame:
    return flights.filter(_inverted(dep, arr)).select(
        F.lit("BR1").alias("rule"),
        F.col(ID).cast("string").alias("record_id"),
        F.col(REG).alias("registration"),
        F.lit("arrival before departure; times swapped").alias("detail"),
    )


# --- BR2 ---------------------------------------------------------------------


ROWS_PER_BUCKET = 2_000_000
MIN_BUCKETS = 8


def _is_flown() -> Column:
    return ~F.coalesce(F.col(CANCELLED), F.lit(False)) & F.col(REG).isNotNull() & F.col(AD).isNotNull()


def _bucketed(flown: DataFrame, num_buckets: int | None) -> DataFrame:
    """``flown`` cut into ranges of (registration, departure, id) and written
    once with the range as ``_bucket``: range bounds are sampled again whenever
    a plan runs, so every reader must see the same stored cut.  The bucket count
    follows the number of flights (``ROWS_PER_BUCKET`` each), not the session's
    settings."""
    n = num_buckets or max(MIN_BUCKETS, -(-flown.count() // ROWS_PER_BUCKET))
    return materialize(
        flown.repartitionByRange(n, REG, AD, ID).withColumn("_bucket", F.spark_partition_id()), "flight-buckets"
    )


def _with_next(bucketed: DataFrame) -> DataFrame:
    """The bucketed flights with ``next_departure``, all other columns kept.

    The ``lead`` runs inside (bucket, registration).  The last flight of an
    aircraft in a bucket takes the first departure of the aircraft's next
    non-empty bucket, from a ``lead`` over the first departures (one row per
    bucket and aircraft).
    """
    firsts = bucketed.groupBy("_bucket", REG).agg(F.min(AD).alias("_first"))
    after = F.lead("_first").over(Window.partitionBy(REG).orderBy("_bucket"))
    after = firsts.select("_bucket", REG, after.alias("_after"))
    in_bucket = F.lead(AD).over(Window.partitionBy("_bucket", REG).orderBy(AD, ID))
    columns = [c for c in bucketed.columns if c != "_bucket"]
    return bucketed.join(after, ["_bucket", REG]).select(*columns, F.coalesce(in_bucket, F.col("_after")).alias("next_departure"))


def next_departure(flights: DataFrame, num_buckets: int | None = None) -> DataFrame:
    """For every flown (not cancelled) flight with a registration and a
    departure, the next departure of the same aircraft in (departure, id)
    order.  Returns (id, registration, actualdeparture, actualarrival,
    next_departure).

    A plain ``lead`` over ``partitionBy(registration)`` would put all flights
    of one aircraft into one task.  Instead the flights are cut into ranges of
    (registration, departure, id), one bucket each, so every bucket holds
    about 1/num_buckets of the rows whatever the key distribution.

    Flights without a departure sort last in the reference order, so they
    are never anyone's next departure that could matter and never have one:
    they are left out.
    """
    return _with_next(_bucketed(flights.filter(_is_flown()).select(ID, REG, AD, AA), num_buckets))


def _overlaps() -> Column:
    return F.coalesce(F.col(AA) > F.col("next_departure"), F.lit(False))


def overlapping_flights(flights: DataFrame) -> DataFrame:
    """Flown flights whose arrival is strictly after the next departure of the
    same aircraft (one pass, as the rule is defined)."""
    return next_departure(flights).filter(_overlaps())


def flag_overlaps(flights: DataFrame) -> DataFrame:
    """The (id, registration) of the overlapping flights, written once."""
    return materialize(overlapping_flights(flights).select(ID, REG), "flagged-flights")


class JudgedFlights(NamedTuple):
    """Flights after BR2's one pass; whole rows travel with their flag.

    ``flights``  all rows;  ``flown``  the flown ones with ``next_departure``;
    ``flagged``  (id, registration) of the overlapping ones, stored;
    ``shared``   flagged ids that other rows carry too, stored (None if no id does);
    ``last``     (registration, last departure) of the flown ones, stored.
    """

    flights: DataFrame
    flown: DataFrame
    flagged: DataFrame
    shared: DataFrame | None
    last: DataFrame


# Columns of flights that an earlier load stored: settled ones are not judged
# again, gone ones were removed then and only stand as someone's next departure.
SETTLED, GONE = "_settled", "_gone"


def _not(flights: DataFrame, column: str) -> Column:
    return ~F.col(column) if column in flights.columns else F.lit(True)


def judge_overlaps(flights: DataFrame, num_buckets: int | None = None) -> JudgedFlights:
    """BR2's judgement of ``flights`` (optionally with ``_settled`` and ``_gone``).

    The flown rows move with all their columns to their bucket, are judged there
    and stored with their next departure; nothing moves them by id.  Only ids
    do: those of the flagged rows meet the ids of all rows, to find the ones that
    occur again.
    """
    judged = _is_flown() & _not(flights, SETTLED)
    bucketed = _bucketed(flights.filter(judged), num_buckets)
    flown = materialize(_with_next(bucketed), "judged-flights")
    carried = [GONE] if GONE in flights.columns else []
    flagged = materialize(flown.filter(_overlaps()).select(ID, REG, *carried), "flagged-flights")
    times = flagged.groupBy(ID).agg(F.count(F.lit(1)).alias("_flagged"))
    rows = flights.select(ID).join(flagged.select(ID).distinct(), ID, "left_semi").groupBy(ID).agg(F.count(F.lit(1)).alias("_rows"))
    shared = materialize(rows.join(times, ID).filter("_rows > _flagged").select(ID), "shared-ids")
    last = materialize(bucketed.groupBy(REG).agg(F.max(AD).alias("_last")), "last-departures")
    return JudgedFlights(flights, flown, flagged, None if shared.isEmpty() else shared, last)


def _removed() -> Column:
    # a removal is by id, so a flagged row without an id stays
    return _overlaps() & F.col(ID).isNotNull()


def _without_shared(rows: DataFrame, judged: JudgedFlights) -> DataFrame:
    if judged.shared is None:
        return rows
    return rows.join(bounded_broadcast(judged.shared), ID, "left_anti").select(*rows.columns)


def drop_overlapping_flights(flights: DataFrame, judged: JudgedFlights | None = None) -> DataFrame:
    """BR2: remove, from the full input, every row whose id is flagged.

    Cancelled flights stay unless they share a flagged id.  Two paths: flown
    rows are dropped by their own flag, and only the flagged ids that other rows
    carry too, normally none, are removed by a join.
    """
    judged = judge_overlaps(flights) if judged is None else judged
    flights = judged.flights
    names = flights.columns
    flown = judged.flown.filter(~_removed()).select(*names)
    rest = flights.filter(~(_is_flown() & _not(flights, SETTLED)))
    kept = _without_shared(flown.unionByName(rest), judged).filter(_not(flights, GONE))
    return kept.drop(SETTLED, GONE)


def open_flights(judged: JudgedFlights, day: Column, window: Column) -> DataFrame:
    """What the next load needs to judge on: whole rows with ``_settled`` and ``_gone``.

    Open are the flown flights that a later load can still give another next
    departure: those whose next departure is missing or lies within ``window``
    of their aircraft's last.  Their days can still change, so the other kept
    rows of the same aircraft and ``day`` come along, settled.  A few rows an
    aircraft, however long its history.
    """
    names = [c for c in judged.flights.columns if c not in (SETTLED, GONE)]
    flown = judged.flown.join(bounded_broadcast(judged.last), REG)
    still = F.col("next_departure").isNull() | (F.col("next_departure") >= F.col("_last") - window)
    gone = _removed() | (F.col(GONE) if GONE in judged.flights.columns else F.lit(False))
    if judged.shared is not None:
        again = judged.shared.select(F.col(ID).alias("_again"))
        flown = flown.join(bounded_broadcast(again), F.col(ID) == F.col("_again"), "left")
        gone = gone | F.col("_again").isNotNull()
    marked = flown.withColumn(GONE, gone)
    now_open = materialize(marked.filter(still).select(*names, F.lit(False).alias(SETTLED), GONE), "open-flights")
    days = materialize(now_open.filter(~F.col(GONE)).select(F.col(REG).alias("_reg"), day.alias("_day")).distinct(), "open-days")
    rest = judged.flights.filter(~(_is_flown() & _not(judged.flights, SETTLED))).filter(_not(judged.flights, GONE)).select(*names)
    settled = marked.filter(~still & ~F.col(GONE)).select(*names).unionByName(_without_shared(rest, judged))
    same_day = settled.join(bounded_broadcast(days), (F.col(REG) == F.col("_reg")) & (day == F.col("_day")), "left_semi")
    return now_open.unionByName(same_day.select(*names, F.lit(True).alias(SETTLED), F.lit(False).alias(GONE)))


def br2_violations(flights: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """One row per flagged flight id (the registration is the smallest one
    flagged under that id, so the result is deterministic)."""
    flagged = flag_overlaps(flights) if flagged is None else flagged
    return (
        flagged.groupBy(F.col(ID).cast("string").alias("record_id"))
        .agg(F.min(REG).alias("registration"))
        .select(
            F.lit("BR2").alias("rule"),
            "record_id",
            "registration",
            F.lit("overlaps the next departure of the same aircraft; flight ignored").alias("detail"),
        )
    )


# --- BR3 ---------------------------------------------------------------------


def _known_registrations(lookup: DataFrame, lookup_reg: str) -> DataFrame:
    return lookup.select(F.col(lookup_reg).alias(REG)).filter(F.col(REG).isNotNull())


def valid_reports(reports: DataFrame, lookup: DataFrame, lookup_reg: str = "aircraft_reg_code") -> DataFrame:
    """BR3: reports whose registration is in the lookup (null is invalid).

    ``lookup`` may be hinted for broadcast by the caller after a size check.
    """
    return reports.join(_known_registrations(lookup, lookup_reg), REG, "left_semi")


def invalid_reports(reports: DataFrame, lookup: DataFrame, lookup_reg: str = "aircraft_reg_code") -> DataFrame:
    return reports.join(_known_registrations(lookup, lookup_reg), REG, "left_anti")


def br3_violations(reports: DataFrame, lookup: DataFrame, lookup_reg: str = "aircraft_reg_code") -> DataFrame:
    return invalid_reports(reports, lookup, lookup_reg).select(
        F.lit("BR3").alias("rule"),
        F.col("pfrid").cast("string").alias("record_id"),
        F.col(REG).alias("registration"),
        F.lit("aircraft not in the lookup; report ignored").alias("detail"),
    )


def violation_counts(*violations: DataFrame) -> DataFrame:
    """Number of violations per rule over any of the ``*_violations`` frames."""
    union = violations[0]
    for v in violations[1:]:
        union = union.unionByName(v)
    return union.groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))
