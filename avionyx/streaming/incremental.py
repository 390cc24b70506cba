"""The logbook aggregation (A3) run incrementally with Structured Streaming.

New post-flight report files are picked up as they land; each micro-batch is
cleaned (BR3, a stream-static semi join against the aircraft lookup) and
counted per (month, registration, reporter), the same ``facts.reporter_counts``
that the batch uses.  Counts add up, so the stream keeps no state: a batch
stores the counts of its own reports and ``logbook_counts`` sums them.  A report
of a month long past is counted like any other; none is late.

The counts are stored by ``plans.store``: one folder a batch, listed in a
manifest that also holds the last batch of every streaming query.

* A batch that is run again after a restart is known by (query id, batch id) and
  adds nothing.
* Every ``compact_every`` folders are summed to one, so what a reader opens is
  bounded.  Folders folded by the compaction before, and the manifests that listed
  them, are deleted then; a reader has the time of a whole round to finish.
* A batch that finds another one published in between fails and is run again
  when its query restarts.

Once all files are processed the counts equal the batch aggregation of the
same reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cleaning, facts
from ..plans import store
from ..sources import schemas

KEYS = ["Year", "Month_Num", facts.REG, "reporteurid"]
COUNTS = "reporter_counts"
SEEN = "_seen"  # "<query id>:<last batch id>" of every query that wrote here
FOLDED = "_folded"  # folders that the last compaction replaced
COMPACT_EVERY = 32


def last_batches(now: store.Published | None) -> dict[str, int]:
    """The last stored batch of every streaming query."""
    seen = now.folders.get(SEEN, []) if now is not None else []
    return {query: int(batch) for query, batch in (s.rsplit(":", 1) for s in seen)}


def store_batch(counts: DataFrame, output_dir: str, query_id: str, batch_id: int, compact_every: int = COMPACT_EVERY) -> bool:
    """Store one batch's ``reporter_counts``; False, and nothing stored, if (query, batch) was stored before."""
    spark, root = counts.sparkSession, output_dir.rstrip("/")
    before = store.published(spark, root)
    seen = last_batches(before)
    if seen.get(query_id, -1) >= batch_id:
        return False
    held = list(before.folders[COUNTS]) if before is not None else []
    folded = list(before.folders[FOLDED]) if before is not None else []
    compacts = len(held) + 1 >= compact_every
    if compacts and held:
        every = before.read(spark, COUNTS).unionByName(counts)
        counts = every.groupBy(*KEYS).agg(F.sum("n").alias("n"))
    folder = store.new_folders(root, before, [COUNTS])[COUNTS]
    counts.write.parquet(f"{root}/{folder}")
    seen[query_id] = batch_id
    folders = {
        COUNTS: [folder] if compacts else [*held, folder],
        FOLDED: held if compacts else folded,
        SEEN: [f"{q}:{b}" for q, b in sorted(seen.items())],
    }
    now = store.publish(spark, root, before, folders)
    if compacts:
        store.forget(spark, root, folded, now.version - compact_every)
    return True


def start_logbook_stream(
    spark: SparkSession,
    reports_dir: str,
    lookup: DataFrame | None,
    output_dir: str,
    checkpoint_dir: str,
    files_per_batch: int = 1,
    available_now: bool = True,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Start the incremental reporter counts over parquet report files in
    ``reports_dir``; every micro-batch adds its counts to ``output_dir``.
    ``lookup=None`` skips BR3; ``available_now`` processes what is there and
    stops."""
    stream = (
        spark.readStream.schema(schemas.REPORTS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(reports_dir)
    )
    valid = cleaning.valid_reports(stream, lookup) if lookup is not None else stream

    def publish(batch: DataFrame, batch_id: int) -> None:
        # the id that the checkpoint keeps over restarts
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        store_batch(facts.reporter_counts(batch), output_dir, query_id, batch_id, compact_every)

    writer = valid.writeStream.option("checkpointLocation", checkpoint_dir).foreachBatch(publish)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def logbook_counts(spark: SparkSession, output_dir: str, personnel: DataFrame) -> DataFrame:
    """The logbook aggregation as of the newest stored batch."""
    stored = store.read_table(spark, output_dir.rstrip("/"), COUNTS)
    return facts.logbook_of_reporters(stored.groupBy(*KEYS).agg(F.sum("n").alias("n")), personnel)
