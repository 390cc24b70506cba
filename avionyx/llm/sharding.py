"""Sharding by longest-processing-time scheduling (operator 8).

Rows with equal texts form a group that must stay together.  Groups, sorted by
size, go one after another to the least-loaded shard, which a heap yields.

The schedule works on a histogram of the group sizes, by one law at every table
size.  A class holds the groups whose sizes share their first ``SIGNIFICANT``
binary digits: one exact size below ``2 ** SIGNIFICANT`` bytes, sizes within one
part in ``2 ** (SIGNIFICANT - 1)`` above.  There are fewer than
``2 ** (SIGNIFICANT - 1) * (65 - SIGNIFICANT)`` classes whatever the input.
Classes go largest first; the groups of a class count as equally large (their
mean), and ``deal_class`` says how many of them the greedy rule gives each shard
without taking them one by one.  Groups then look their shard up by their rank
in their class.  Ranks and slots are numbered in hashed parts, so neither a
large group, a large class nor a whole shard passes through one task.

Defined results: a null text has size 1, CRC 0 and is grouped with the other
null texts (not with empty ones).  Null ids and repeated rows get slots of their
own.  A shard that gets no group is empty.
"""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avionyx.session import materialize

SIGNIFICANT = 11
SLOT_ROWS = 200_000
LOT = 10_000  # copies of one row that are numbered together
BROADCAST_ENDS = 1_000_000


def deal_class(loads: list[int], size: int, count: int) -> list[int]:
    """How many of ``count`` groups of ``size`` bytes each shard gets if each goes to the least-loaded shard.

    One by one, the groups take the ``count`` smallest of the loads ``load + k * size``
    (k = 0, 1, ...) that shards have before taking a group.  The highest level below
    which no more than ``count`` of these lie is found by halving; what is left of the
    count, less than one group a shard, goes through the heap.
    """

    def below(level: int) -> list[int]:
        return [max(0, (level - load) // size + 1) for load in loads]

    lo, hi = min(loads) - 1, max(loads) + size * count
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if sum(below(mid)) <= count else (lo, mid - 1)
    taken = below(lo)
    heap = [(load + n * size, s) for s, (load, n) in enumerate(zip(loads, taken, strict=True))]
    heapq.heapify(heap)
    for _ in range(count - sum(taken)):
        load, shard = heapq.heappop(heap)
        taken[shard] += 1
        heapq.heappush(heap, (load + size, shard))
    return taken


def longest_first(classes: list[tuple[int, int, int]], shards: int) -> dict[int, list[int]]:
    """``{class: groups per shard}`` for ``(class, groups, bytes)``, classes of larger groups first."""
    loads = [0] * shards
    out = {}
    for name, count, total in sorted(classes, reverse=True):
        taken = out[name] = deal_class(loads, max(1, total // count), count)
        loads = [load + n * total // count for load, n in zip(loads, taken, strict=True)]
    return out


def size_class(size: Column) -> Column:
    """The size with all but its first ``SIGNIFICANT`` binary digits set to zero; larger classes hold larger groups."""
    drop = F.greatest(F.lit(0), F.length(F.bin(size)) - SIGNIFICANT)
    return F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)


def _group(text: Column) -> Column:
    """64-bit key of equal texts; a clash only keeps two groups together."""
    return F.when(text.isNull(), F.lit(-1).cast("long")).otherwise(F.xxhash64(text))


def assign_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row: sizes of shards are near equal,
    equal texts share a shard, slots of a shard count from 0 without a gap."""
    text = F.col(f"`{text_col}`")
    rows = materialize(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            _group(text).alias("group"),
        ),
        "rows",
    )
    spark = docs.sparkSession
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))
    groups = materialize(groups.withColumn("class", size_class(F.col("bytes"))), "groups")
    # fewer than 2 ** (SIGNIFICANT - 1) * (65 - SIGNIFICANT) rows
    classes = groups.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows")).collect()
    dealt = longest_first([(r["class"], r["n"], r["bytes"]) for r in classes], shards)
    ends = spark.createDataFrame([(c, list(accumulate(taken))) for c, taken in dealt.items()], "class long, ends array<long>")
    if len(dealt) * shards <= BROADCAST_ENDS:
        ends = F.broadcast(ends)
    once = F.lit(1).cast("long").alias("copies")
    ranked = number_rows(groups.select("group", "class", once), sum(r["n"] for r in classes), "class", "place")
    # the shard of a group is the number of shards whose share of its class ends at its place or before
    placed = ranked.join(ends, "class").select("group", F.size(F.filter("ends", lambda end: end <= F.col("place"))).alias("shard"))
    distinct = rows.groupBy("doc_id", "size", "text_crc32", "group").agg(F.count(F.lit(1)).alias("copies"))
    put = distinct.join(placed, "group")
    return number_rows(put, sum(r["n_rows"] for r in classes), "shard", "slot").drop("group")


def number_rows(rows: DataFrame, n_rows: int, within: str, name: str) -> DataFrame:
    """Every row ``copies`` times, with a gapless number ``name`` from 0 for each value of ``within``.

    Copies travel as a count, in lots of at most ``LOT``.  The lots of a value are
    dealt by a hash into parts of about ``SLOT_ROWS`` rows, numbered inside the
    part, and moved up by the rows of the parts before it; only the small table
    of part sizes is summed in order.
    """
    parts = max(1, -(-n_rows // SLOT_ROWS))
    order = [c for c in rows.columns if c not in (within, "copies")]
    lots = rows.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(LOT).cast("long"))))
    dealt = lots.withColumn("n", F.least(F.col("copies") - F.col("lot"), F.lit(LOT))).withColumn(
        "part", F.pmod(F.xxhash64(*order, "lot"), F.lit(parts))
    )
    sizes = dealt.groupBy(within, "part").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy(within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(within, "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(within, "part").orderBy(*order, "lot").rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("offset") + F.sum("n").over(inside) - F.col("n")
    numbered = dealt.join(offsets, [within, "part"]).withColumn("first", first.cast("long"))
    return numbered.select(*order, within, F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias(name))
