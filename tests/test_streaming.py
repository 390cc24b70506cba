import os
import tempfile

import pytest

from conftest import SMOKE_DIR

from avionyx.operators import cleaning, facts
from avionyx.plans import store
from avionyx.sources import load_test_sources
from avionyx.streaming.incremental import COUNTS, KEYS, last_batches, logbook_counts, start_logbook_stream, store_batch


def test_stream_resumes_from_checkpoint_and_matches_batch(spark):
    src = load_test_sources(spark, SMOKE_DIR)
    base = tempfile.mkdtemp(prefix="avionyx-stream-")
    landing, out, ckpt = f"{base}/landing", f"{base}/out", f"{base}/ckpt"
    first = src.reports.filter("pfrid % 2 = 0")
    second = src.reports.filter("pfrid % 2 = 1")

    first.repartition(2).write.parquet(landing)
    start_logbook_stream(spark, landing, src.aircraft, out, ckpt).awaitTermination()
    (query, last), = last_batches(store.published(spark, out)).items()
    assert last == 1

    # more files land; the restarted query, known by its id, only reads the new ones
    second.repartition(2).write.mode("append").parquet(landing)
    start_logbook_stream(spark, landing, src.aircraft, out, ckpt).awaitTermination()
    assert last_batches(store.published(spark, out)) == {query: 3}
    streamed = sorted(logbook_counts(spark, out, src.personnel).collect())
    valid = cleaning.valid_reports(src.reports, src.aircraft)
    batch = sorted(facts.logbook_aggregates(valid, src.personnel).collect())
    assert streamed == batch


def counts_of(spark, *rows):
    return spark.createDataFrame(rows, "Year int, Month_Num int, aircraftregistration string, reporteurid string, n long")


def stored(spark, out):
    rows = store.read_table(spark, out, COUNTS).groupBy(*KEYS).sum("n").collect()
    return sorted(tuple(r) for r in rows)


def test_a_replayed_batch_adds_nothing(spark):
    out = tempfile.mkdtemp(prefix="avionyx-replay-") + "/out"
    one = counts_of(spark, (1998, 3, "XY-A", "r1", 2))
    assert store_batch(one, out, "q", 0) and not store_batch(one, out, "q", 0)
    assert stored(spark, out) == [(1998, 3, "XY-A", "r1", 2)]
    assert store_batch(one, out, "q", 1) and not store_batch(one, out, "q", 0)
    # another query's batches are its own
    assert store_batch(one, out, "other", 0)
    assert stored(spark, out) == [(1998, 3, "XY-A", "r1", 6)]
    assert last_batches(store.published(spark, out)) == {"q": 1, "other": 0}


def test_folders_and_manifests_level_off(spark):
    out = tempfile.mkdtemp(prefix="avionyx-compact-") + "/out"
    sizes = []
    for batch in range(14):
        month = counts_of(spark, (1998, batch % 2 + 1, "XY-A", "r1", 1), (1990, 1, "XY-B", None, 1))  # a month long past
        assert store_batch(month, out, "q", batch, compact_every=3)
        now = store.published(spark, out)
        assert len(now.folders[COUNTS]) <= 3
        sizes.append((len(os.listdir(f"{out}/data/{COUNTS}")), len([f for f in os.listdir(f"{out}/_manifest") if f.endswith(".json")])))
        # a batch run again after the compaction that took it in
        assert not store_batch(month, out, "q", batch, compact_every=3)
    assert max(sizes[7:]) <= max(sizes[:8]) and max(s for s, _ in sizes) <= 6
    want = [(1990, 1, "XY-B", None, 14), (1998, 1, "XY-A", "r1", 7), (1998, 2, "XY-A", "r1", 7)]
    assert stored(spark, out) == want


def test_a_batch_that_lost_the_race_fails_whole(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="avionyx-race-") + "/out"
    one = counts_of(spark, (1998, 3, "XY-A", "r1", 2))
    store_batch(one, out, "q", 0)
    seen = store.published(spark, out)
    store_batch(one, out, "other", 0)
    with monkeypatch.context() as m:
        m.setattr(store, "published", lambda *_: seen)
        with pytest.raises(store.AlreadyPublished):
            store_batch(one, out, "q", 1)
    assert store_batch(one, out, "q", 1)
    assert stored(spark, out) == [(1998, 3, "XY-A", "r1", 6)]
