"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 12).

1. One pass over the documents counts words, weighs the quality of each text
   and draws its key ``-ln(u) / quality``: u comes from a digest of the row, so
   reruns agree.  Only these narrow rows are written; texts are not moved.
2. Sources share the budget by weight.  A target stops at ``most_epochs`` times
   the size of its source, and what it leaves goes to the others by weight
   until none is above: a few rounds over the table of sources.
3. A target of e whole sizes of its source and a rest takes every document e
   times; the rest goes to the documents with the smallest keys.  The rows are
   range-partitioned on (source, key), sizes are summed in order inside each
   range and moved up by the sums of the ranges before it.  The document that
   crosses the rest gives just the words that are missing, so a source meets its
   rounded target exactly.

DataFrame functions only.  A source with a third of all rows spreads over as
many ranges as its rows ask for; equal rows are spread by a salt.

Defined results: a null or empty text has size 0 and takes nothing; null ids
count as ids of their own; the null source is a source, last in order; repeated
rows are documents of their own that share a key; ties in the key go by id, then
size; an empty table gives no rows.  Other columns of ``docs`` are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avionyx.operators.joins import bounded_broadcast
from avionyx.operators.keys import assign_surrogate_keys
from avionyx.session import materialize

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
NOISE = "0123456789#*$%&|<>{}[]=_@/^~+"
LEAST_QUALITY = 0.05
ROWS_PER_RANGE = 1_000_000
LEAST_RANGES = 8


def clean_share(text: Column) -> Column:
    """Quality of a text: the share of its characters in words that are neither digits nor symbols."""
    inked = F.length(F.translate(text, BLANKS, ""))
    plain = F.length(F.translate(text, BLANKS + NOISE, ""))
    return F.when(inked > 0, F.greatest(F.lit(LEAST_QUALITY), plain / inked)).otherwise(F.lit(LEAST_QUALITY))


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of the parts' digest."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts], F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: Sequence[int] | DataFrame, most_epochs: int, budget: int | None) -> DataFrame:
    """``rank, source, source_size, target`` for the table ``source, source_size``.

    Only two sums a round reach the driver.  Sums are exact; a target is one
    division.
    """
    ranked = assign_surrogate_keys(sizes, [F.col("source").isNull(), F.col("source")], "rank")
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("named"), F.col("weight").cast("long").alias("weight"))
        ranked = ranked.join(given, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
        ranked = ranked.withColumn("weight", F.coalesce("weight", F.lit(0).cast("long")))
    else:
        cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
        ranked = ranked.withColumn("weight", F.get(cycle, (F.col("rank") - 1) % len(weights)))
    table = materialize(ranked.withColumn("cap", F.col("source_size") * most_epochs), "sources")
    total, free = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    left = total if budget is None else budget
    all_words = left
    while True:
        # sums of earlier rounds only grow the share, so a capped source stays capped
        above = F.col("cap").cast("decimal(38,0)") * F.lit(free) <= F.col("weight").cast("decimal(38,0)") * F.lit(left)
        held, rest = table.agg(
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))
        ).first()
        if rest == free:
            break
        free, left = rest, all_words - held
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(free)) if free else F.lit(0.0)
    return table.select("rank", "source", "source_size", F.when(above, F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] | DataFrame = (1, 2, 3),
    most_epochs: int = 3,
    budget: int | None = None,
    quality: Column | None = None,
    seed: int = 12,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, quality`` for every row of ``docs``.

    ``weights`` repeat over the sources in order, or are a table ``source,
    weight`` of whole numbers; ``budget`` is in words (all words of ``docs`` if
    None); ``quality`` is a positive column (``clean_share`` of the text if None).
    """
    text, source = F.col(f"`{text_col}`"), F.col(f"`{source_col}`")
    doc_id = F.col(f"`{id_col}`")
    weight = F.greatest(F.lit(1e-9), quality.cast("double")) if quality is not None else clean_share(text)
    rows = materialize(
        docs.select(
            doc_id.alias("doc_id"),
            source.alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
            F.coalesce(weight, F.lit(LEAST_QUALITY)).alias("quality"),
            uniform(seed, doc_id, source, F.md5(F.coalesce(text, F.lit("")))).alias("u"),
        ),
        "sizes",
    ).withColumn("key", -F.log("u") / F.col("quality"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialize(source_targets(sizes, weights, most_epochs, budget), "targets")
    n_ranges = max(LEAST_RANGES, -(-rows.count() // ROWS_PER_RANGE))
    named = sources.select("rank", F.col("source").alias("of"))
    ordered = rows.join(bounded_broadcast(named), F.col("source").eqNullSafe(F.col("of"))).select(
        "rank", "key", "doc_id", "size", "quality"
    )
    # bounds are sampled anew whenever a plan runs: the ranges are written once, with their number
    ranged = materialize(
        ordered.repartitionByRange(n_ranges, "rank", "key", "doc_id", "size", F.rand(seed)).withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    inside = Window.partitionBy("part", "rank").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("part", "rank").agg(F.sum("size").alias("words"))
    offsets = sums.select("part", "rank", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    goal = F.floor(F.col("target") + 0.5)
    plan = sources.select(
        "rank",
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long").alias("epochs"),
        F.when(F.col("source_size") > 0, goal % F.col("source_size")).otherwise(F.lit(0)).cast("long").alias("rest"),
    )
    placed = (
        ranged.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["part", "rank"])
        .join(bounded_broadcast(plan), "rank")
    )
    missing = F.col("rest") - F.col("offset") - F.col("inside")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), missing))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "quality")
