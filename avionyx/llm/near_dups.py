"""MinHash near-duplicate components over word shingles (operator 6).

1. One pass turns every text into the set of its distinct word shingles (as
   64-bit hashes), many universal hash minima ``a * x + b``, one key per band
   of minima, and two bits of every minimum as a signature.
2. Texts with equal sets are one class from then on: thousands of copies cost
   one node.  Classes that share a band key are a bucket.
3. Each bucket proposes star pairs (every member with one hub chosen by a
   hash, so different buckets have different hubs).  Signatures discard pairs
   that are clearly apart, the full sets confirm the rest.
4. Components come from alternating large-star and small-star.  Buckets that
   still hold more than one component then propose every pair across
   components whose signatures are close; those are confirmed on the full sets
   as well, so no link that a bucket holds is lost.  Pairs inside a component
   are never made.

With 50 bands of 6 minima a pair at similarity 0.8 shares no bucket with
probability 2.5e-7; the signature cut (125 of 600 two-bit minima may differ) is
four standard deviations below 0.8.  In a group of thousands of half-similar
texts the signatures alone leave many pairs across components; an exact prefix
test on the rarest shingles (two sets that reach the similarity share some of
them) drops more before the full sets are fetched, and a pair that shares several
buckets is proposed in one of them only.

Defined results: a null or empty text, or one without words, has the empty set,
is linked with nothing and is its own component.  A text with fewer words than
a shingle has its whole sequence as one shingle.  Repeated rows share a class.
Rows with a null ``doc_id`` take part; a component holding no other id has a
null ``component_id`` and its rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avionyx.llm.components import connected_components
from avionyx.llm.text import WORD, free_name, giving_back, lower_az, slices
from avionyx.session import materialize

BANDS, ROWS = 50, 6
BANDED = BANDS * ROWS
HASHES = 600
SIG_LONGS = (2 * HASHES + 63) // 64
MAX_DIFFERENT = 125
RARE = 3
SEED = 20240229

_SIG = [f"s{i}" for i in range(SIG_LONGS)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (the splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of one slice."""
    found = [WORD.findall(lower_az(t)) if t else [] for t in texts]
    flat = [w for ws in found for w in ws]
    hashes = pd.util.hash_array(np.array(flat, dtype=object)) if flat else np.zeros(0, np.uint64)
    out, at = [], 0
    for ws in found:
        n = len(ws)
        h = hashes[at : at + n]
        at += n
        width = min(k, n)
        if not n:
            out.append(h)
            continue
        code = np.full(n - width + 1, width, np.uint64)
        for j in range(width):
            code = code * np.uint64(0x9E3779B97F4A7C15) + h[j : n - width + 1 + j]
        out.append(np.unique(mix(code)))
    return out


def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(1, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
    return a, rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(texts x HASHES) minima of the universal hashes; no set may be empty."""
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    a, b = _family()
    out = np.empty((len(sets), HASHES), np.uint32)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat(x * a[i] + b[i], starts)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """(texts x BANDS) 64-bit keys; the band number is part of the key."""
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(low), BANDS)).copy()
    cube = low[:, :BANDED].reshape(len(low), BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cube[:, :, r])
    return key.view(np.int64)


def signatures(low: np.ndarray) -> np.ndarray:
    """(texts x SIG_LONGS) two bits of every minimum (after mixing), packed."""
    two = mix(low.astype(np.uint64)) & np.uint64(3)
    padded = np.zeros((len(low), SIG_LONGS * 32), np.uint64)
    padded[:, :HASHES] = two
    shifts = np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce(padded.reshape(len(low), SIG_LONGS, 32) << shifts, axis=2).view(np.int64)


_SKETCH = "doc_id long, text_hash long, n_shingles long, node long, bands array<long>, " + ", ".join(f"{s} long" for s in _SIG)


def _sketches(docs: DataFrame, k: int) -> DataFrame:
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in slices(texts):
                keys = [batch.column(i).slice(lo, hi - lo) for i in (0, 1)]
                sets = shingle_sets(texts[lo:hi], k)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                node = np.zeros(len(sets), np.int64)
                bands = np.zeros((len(sets), BANDS), np.int64)
                sig = np.zeros((len(sets), SIG_LONGS), np.int64)
                if len(full):
                    held = [sets[i] for i in full]
                    low = minima(held)
                    # order-free class key of a set: its size and a sum of mixed hashes
                    node[full] = mix(
                        np.add.reduceat(mix(np.concatenate(held) + np.uint64(SEED)), np.cumsum([0, *sizes[full][:-1]]))
                        + sizes[full].astype(np.uint64)
                    ).view(np.int64)
                    bands[full], sig[full] = band_keys(low), signatures(low)
                offsets = np.arange(0, (len(sets) + 1) * BANDS, BANDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *keys,
                        pa.array(sizes),
                        pa.array(node),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel())),
                        *[pa.array(sig[:, i]) for i in range(SIG_LONGS)],
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "node", "bands", *_SIG],
                )

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, _SKETCH)


def _full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``(node, shingles)`` of the wanted classes, from the text of one row each.

    The row is told by its id, which may be null, and the hash of its text.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    texts = rows.join(wanted.alias("w"), same).select("w.node", "d.text")

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                sets = shingle_sets(texts[lo:hi], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[lo:hi], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "shingles"],
                )

    return texts.mapInArrow(run, "node long, shingles binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets reach the similarity."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
                if len(x) > len(y):
                    x, y = y, x
                shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "u long, v long")


def _close(a: str, b: str) -> Column:
    """True unless the two-bit signatures differ in more than MAX_DIFFERENT minima."""
    lows = F.lit(0x5555555555555555).cast("long")
    different = F.lit(0)
    for s in _SIG:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        different = different + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(lows))
    return different <= MAX_DIFFERENT


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``node, n, probe``: the rarest shingles of each set, in one common order."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, held in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(held.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), node, np.int64)), pa.array(x)], names=["node", "shingle"]
                )

    each = sets.select("node", "shingles").mapInArrow(run, "node long, shingle long")
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
    ordered = (
        each.join(often, "shingle")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("x"))
        .select("node", F.size("x").alias("n"), F.col("x.shingle").alias("x"))
    )
    p = percent
    return ordered.select(
        "node",
        "n",
        F.expr(f"slice(x, 1, n - cast(ceil({p} * n / 100) as int) + {RARE})").alias("probe"),
    )


def _may_reach(percent: int) -> Column:
    """False only for pairs that can't reach the similarity (the prefix filter of set-similarity joins).

    Two sets of ``n`` and ``m`` shingles that reach it share at least
    ``need`` = percent * (n + m) / (100 + percent) of them; then their
    ``n - need + RARE`` and ``m - need + RARE`` rarest have ``RARE`` in common
    (or all of ``need``, if that is less).
    """
    need = f"cast(ceil({percent} * (a.n + b.n) / {100 + percent}) as int)"
    first = lambda t: f"slice({t}.probe, 1, greatest(0, {t}.n - {need} + {RARE}))"
    return F.expr(
        f"100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)"
        f" and size(array_intersect({first('a')}, {first('b')})) >= least({RARE}, {need})"
    )


def _by_signature(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    return (
        pairs.alias("p")
        .join(sigs.alias("a"), F.col("p.u") == F.col("a.node"))
        .join(sigs.alias("b"), F.col("p.v") == F.col("b.node"))
        .where(_close("a", "b"))
        .select("p.u", "p.v")
    )


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash`` for every row of ``docs``.

    Documents are linked where ``100 * intersection >= percent * union`` of
    their ``k``-word shingle sets; ``component_id`` is the smallest id
    reachable, ``kept`` marks the rows that carry it, ``text_hash`` is the
    xxhash64 of the text.  ``percent`` below 80
    needs more bands.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = materialize(_sketches(docs, k), "sketches")
    filled = rows.where("n_shingles > 0")
    # one row stands for the texts of a class; its id and hash are only needed to find the text again
    classes = filled.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("row")).select("node", "row.doc_id", "row.text_hash")
    banded = filled.select("node", "bands").dropDuplicates(["node"]).select("node", F.explode("bands").alias("bucket"))
    hubs = (
        banded.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("node", "bucket").alias("h"), "node")).alias("hub"))
        .where("n > 1")
        .select("bucket", F.col("hub.node").alias("hub"))
    )
    members = materialize(banded.join(hubs, "bucket"), "buckets")
    wanted = members.select("node").distinct()
    sigs = materialize(filled.select("node", *_SIG).join(wanted, "node", "left_semi").dropDuplicates(["node"]), "signatures")
    sets = materialize(_full_sets(docs, classes.join(wanted, "node", "left_semi"), k).dropDuplicates(["node"]), "sets")

    stars = members.where("node <> hub").select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")).distinct()
    tried = materialize(_by_signature(stars, sigs), "pairs")
    links = materialize(_confirm(tried, sets, percent), "links")
    parts = materialize(connected_components(links), "components")

    # buckets that hold more than one component: the pairs across them
    placed = (
        members.select("bucket", "node")
        .join(parts, "node", "left")
        .join(sigs, "node")
        .select("bucket", "node", F.coalesce("component", "node").alias("component"), *_SIG)
    )
    split = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    rows_open = materialize(placed.join(split.select("bucket"), "bucket", "left_semi"), "open")
    nodes_open = rows_open.select("node").distinct()
    bands = filled.select("node", "bands").join(nodes_open, "node", "left_semi").dropDuplicates(["node"])
    prefixes = materialize(_prefixes(sets.join(nodes_open, "node", "left_semi"), percent).join(bands, "node"), "prefixes")
    rows_open = rows_open.join(prefixes, "node")
    a, b = rows_open.alias("a"), rows_open.alias("b")
    # a pair is proposed once, in the smallest of the buckets that it shares
    once = F.array_min(F.array_intersect("a.bands", "b.bands")) == F.col("a.bucket")
    across = (
        a.join(
            b,
            (F.col("a.bucket") == F.col("b.bucket"))
            & (F.col("a.component") < F.col("b.component"))
            & _close("a", "b")
            & _may_reach(percent)
            & once,
        )
        .select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v"))
        .distinct()
        .join(tried, ["u", "v"], "left_anti")
    )
    more = materialize(_confirm(across, sets, percent), "links")
    if more.isEmpty():
        final = parts
    else:
        final = connected_components(links.unionByName(more))

    labelled = rows.select("doc_id", "text_hash", "n_shingles", "node").join(final, "node", "left")
    labelled = labelled.withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")))
    least = labelled.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = labelled.join(least, "component", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
        "text_hash",
    )


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the smallest id.

    Rows that repeat this id and its text keep one row.  Rows without words are
    linked with nothing, so only exact repeats of such a row go; rows with a
    null id can't be told apart by id and stay.
    """
    key, text_key, rank = (free_name(docs, n) for n in ("kept_id", "text_key", "rank"))
    verdicts = (
        near_duplicates(docs, k, percent, id_col, text_col)
        .where("kept and doc_id is not null")
        .select(F.col("doc_id").alias(key), F.col("text_hash").alias(text_key))
        .distinct()
    )
    keyed = docs.withColumns({key: F.col(f"`{id_col}`"), text_key: F.xxhash64(F.col(f"`{text_col}`"))})
    kept = keyed.join(verdicts, [key, text_key], "left_semi")
    order = Window.partitionBy(key, text_key).orderBy(F.lit(0))
    one = kept.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    one = one.select(*[F.col(f"`{c}`") for c in docs.columns])
    return one.unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
