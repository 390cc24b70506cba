"""Prefix trie of conversations from sorted LCPs (operator 11).

1. A turn becomes a digest of (role, text) and its word count; a conversation
   the sequence of its digests in turn order.  Texts are not moved.
2. Equal sequences form one class, with its number of members, smallest id and
   the digest of its sorted ids.
3. The distinct sequences are range-partitioned, so that each block holds a
   contiguous run of the sorted order.  In a block neighbours give an array of
   longest common prefixes (LCP) and a sparse table its range minima.  Every
   candidate prefix (sequence i, depth d) binary-searches its left and right
   extents independently: the farthest neighbours that still share d turns.
   The candidates whose left extent is themselves name the nodes, and sums over
   a node's subtree are differences of running sums.
4. A node that reaches neither end of its block is complete.  The others are
   prefixes of the block's first or last sequence; these two rows a block carry
   their part sums to one more sorted run, where the same search joins them.

A block holds at most about ``BLOCK_TURNS`` turns of distinct sequences, so a
first turn that a third of all conversations share is spread over many blocks.
The ids of one class pass through one task in sorted order, because a SHA-256
of them must; that task streams them and holds none.

Defined results: a null role or text counts as empty; turns go by number, null
first, equal numbers by role, then by the digest of the turn, repeated rows stay
repeated turns; rows without a conversation id are left out; an empty table has
no node; other columns are ignored.  A conversation's digests (16 bytes a turn)
form one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avionyx.operators.joins import bounded_broadcast
from avionyx.session import materialize

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
DIGEST = 16
BLOCK_TURNS = 500_000
ROWS_PER_PART = 500_000
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE_COLUMNS = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turns`` with an array of ``(digest, words)`` in turn order."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    words = F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0))
    rows = turns.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
        F.struct(
            F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), digest.alias("digest"), words.cast("long").alias("words")
        ).alias("t"),
    )
    ordered = F.sort_array(F.collect_list("t"))
    short = F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return rows.groupBy("conv_id").agg(short.alias("turns"))


def with_shared_heads(convs: DataFrame, group: int, turns: Column, most: int) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of conversation ``c - c % group``, then its own from there on.

    ``turns`` gives h (0 to ``most``) from ``conv_id``.
    """
    heads = convs.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, most).alias("head")
    )
    joined = convs.withColumn("h", turns.cast("int")).join(heads, (F.col("conv_id") - F.col("conv_id") % group) == F.col("head_id"), "left")
    empty = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("head", empty), F.lit(1), F.col("h"))
    rest = F.slice(F.col("turns"), F.col("h") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def classes(convs: DataFrame) -> DataFrame:
    """``path, words, n, conv_id, ends``: distinct sequences with their members' number, smallest id and digest.

    ``path`` is the digests in a row, so byte order is the order of sequences.
    """
    rows = materialize(
        convs.select(
            F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "").alias("hexes"), F.col("turns.words").alias("words"), "conv_id"
        ).select(F.unhex("hexes").alias("path"), "words", "conv_id"),
        "paths",
    )
    parts = max(8, -(-rows.count() // ROWS_PER_PART))
    key = F.xxhash64("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words, first, n, digest = None, None, 0, 0, None
        for batch in batches:
            done: list[tuple] = []
            paths, ids, counts = batch.column(0), batch.column(2).to_numpy(), batch.column(1)
            codes = paths.dictionary_encode()
            number = codes.indices.to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(number)]]) if len(number) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                path = codes.dictionary[int(number[lo])].as_py()
                text = ",".join(map(str, ids[lo:hi].tolist())).encode()
                if path == now:
                    digest.update(b"," + text)
                    n += int(hi - lo)
                    continue
                if now is not None:
                    done.append((now, words, n, first, digest.hexdigest()))
                now, words, first, n = path, counts[int(lo)].as_py(), int(ids[lo]), int(hi - lo)
                digest = hashlib.sha256(text)
            if done:
                yield _class_batch(done)
        if now is not None:
            yield _class_batch([(now, words, n, first, digest.hexdigest())])

    sorted_rows = rows.repartition(parts, key).sortWithinPartitions("path", "conv_id")
    return sorted_rows.mapInArrow(run, "path binary, words array<long>, n long, conv_id long, ends string")


def _class_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["path", "words", "n", "conv_id", "ends"]
    )


class SparseTable:
    """Range minima: level k holds the minimum of each run of 2**k values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (1 << len(self.levels)) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of ``values[lo:hi]`` for pairs with ``lo < hi``: two overlapping runs."""
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.levels[0].dtype)
        for level in np.unique(k):
            own = k == level
            runs = self.levels[level]
            out[own] = np.minimum(runs[lo[own]], runs[hi[own] - (1 << int(level))])
        return out


def common_prefixes(paths: list[bytes]) -> np.ndarray:
    """``out[i]``: turns that sequences i - 1 and i share; ``out[0]`` is -1."""
    out = np.full(len(paths), -1, np.int64)
    for i in range(1, len(paths)):
        a, b = paths[i - 1], paths[i]
        n = min(len(a), len(b))
        if a[:n] == b[:n]:
            out[i] = n // DIGEST
        else:
            x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
            out[i] = int(np.argmax(x != y)) // DIGEST
    return out


def extents(lcp: np.ndarray, who: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last sequence that share ``depth`` turns with sequence ``who``, by two binary searches each.

    Sequences lo..hi share d turns if the minimum of ``lcp[lo + 1 : hi + 1]`` is at least d.
    """
    table, n = SparseTable(lcp), len(lcp)
    left_low, left_high = np.zeros(len(who), np.int64), who.copy()
    right_low, right_high = who.copy(), np.full(len(who), n - 1)
    while True:
        open_left, open_right = left_low < left_high, right_low < right_high
        if not (open_left.any() or open_right.any()):
            return left_low, right_low
        i = np.flatnonzero(open_left)
        if len(i):
            mid = (left_low[i] + left_high[i]) // 2
            fits = table.least(mid + 1, who[i] + 1) >= depth[i]
            left_high[i] = np.where(fits, mid, left_high[i])
            left_low[i] = np.where(fits, left_low[i], mid + 1)
        i = np.flatnonzero(open_right)
        if len(i):
            mid = (right_low[i] + right_high[i] + 1) // 2
            fits = table.least(who[i] + 1, mid + 1) >= depth[i]
            right_low[i] = np.where(fits, mid, right_low[i])
            right_high[i] = np.where(fits, right_high[i], mid - 1)


class Trie:
    """The nodes over sorted distinct sequences, in order of (first sequence, depth)."""

    def __init__(self, paths: list[bytes]):
        self.lcp = common_prefixes(paths)
        size = np.array([len(p) // DIGEST for p in paths], np.int64)
        who = np.repeat(np.arange(len(paths)), size + 1)
        depth = np.arange(len(who)) - np.repeat(np.cumsum(size + 1) - (size + 1), size + 1)
        left, right = extents(self.lcp, who, depth)
        node = left == who  # each node once: at its first sequence
        self.first, self.last, self.depth = who[node], right[node], depth[node]
        # the first node of each sequence, and the number of its turns
        self.begin = np.searchsorted(self.first, np.arange(len(paths) + 1))
        self.size = size

    def at(self, who: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Number of the node that is the first ``depth`` turns of sequence ``who``."""
        first, _ = extents(self.lcp, who, depth)
        return self.begin[first] + depth - (self.lcp[first] + 1)

    def parents(self) -> np.ndarray:
        """Number of each node's parent, -1 for the root."""
        out = np.arange(len(self.first)) - 1  # within a sequence depths follow each other
        head = self.begin[:-1][np.diff(self.begin) > 0]
        head = head[self.depth[head] > 0]
        out[head] = self.at(self.first[head], self.depth[head] - 1)
        out[self.depth == 0] = -1
        return out

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sum of ``values`` (one a node) over each node's subtree, itself included.

        The subtree of a node holds the deeper nodes of its first sequence and
        all nodes of the sequences after it up to its right extent.
        """
        run = np.concatenate([[0], np.cumsum(values)])
        return run[self.begin[self.last + 1]] - run[np.arange(len(values))]


def _words_at(trie: Trie, words: list[np.ndarray]) -> np.ndarray:
    """Words of each node's last turn, 0 for the root."""
    flat = np.concatenate([np.zeros(0, np.int64), *[np.asarray(w, np.int64) for w in words]])
    start = np.concatenate([[0], np.cumsum(trie.size)])
    out = np.zeros(len(trie.first), np.int64)
    some = trie.depth > 0
    out[some] = flat[start[trie.first[some]] + trie.depth[some] - 1]
    return out


def _ranges_least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return SparseTable(values).least(lo, hi)


_BLOCK = pa.schema(
    [
        ("kind", pa.int32()),  # 0: complete node, 1: first or last sequence of a block
        *[(c, pa.int64()) for c in NODE_COLUMNS],
        ("parent_conv_id", pa.int64()),
        ("parent_key", pa.string()),  # of a parent that reaches an end of the block
        ("ends", pa.string()),
        ("path", pa.binary()),
        ("words", pa.list_(pa.int64())),
        # what the nodes on the way of a border sequence hold in this block, from depth 0 on
        ("part_from", pa.int64()),
        *[(f"part_{c}", pa.list_(pa.int64())) for c in ("n", "conv_id", "children", "leaves", "saved")],
        ("part_ends", pa.list_(pa.string())),
    ]
)
_BLOCK_SQL = (
    "kind int, " + ", ".join(f"{c} long" for c in NODE_COLUMNS) + ", parent_conv_id long, parent_key string, ends string, path binary, words array<long>, part_from long, "
    "part_n array<long>, part_conv_id array<long>, part_children array<long>, part_leaves array<long>, part_saved array<long>, part_ends array<string>"
)


def prefix_keys(path: bytes, depths: int) -> list[str]:
    """A key for each of the first ``depths`` prefixes, the empty one included."""
    digest, out = hashlib.md5(usedforsecurity=False), []
    for d in range(depths):
        out.append(f"{d}:{digest.hexdigest()}")
        digest.update(path[d * DIGEST : (d + 1) * DIGEST])
    return out


def block_nodes(paths: list[bytes], words: list[np.ndarray], n: np.ndarray, conv_id: np.ndarray, ends: list[str]) -> Iterator[dict]:
    """Complete nodes and border sequences of one block of sorted distinct sequences, as columns."""
    trie = Trie(paths)
    count = len(trie.first)
    members = np.concatenate([[0], np.cumsum(n)])
    n_convs = members[trie.last + 1] - members[trie.first]
    least = _ranges_least(conv_id, trie.first, trie.last + 1)
    parent = trie.parents()
    ending = [""] * count
    for i in range(len(paths)):  # a sequence's own node is its deepest
        ending[int(trie.begin[i + 1]) - 1] = ends[i]
    border = (trie.first == 0) | (trie.last == len(paths) - 1)
    inner = ~border
    children = np.bincount(parent[inner & (parent >= 0)], minlength=count)
    leaves = trie.below((inner & (children == 0)).astype(np.int64))
    saved = trie.below(np.where(inner, (n_convs - 1) * _words_at(trie, words), 0))
    at = np.flatnonzero(inner)
    keys: dict[int, str] = {}
    for i in (0, len(paths) - 1):
        nodes = trie.at(np.full(int(trie.size[i]) + 1, i), np.arange(int(trie.size[i]) + 1))
        keys.update(zip(nodes.tolist(), prefix_keys(paths[i], len(nodes)), strict=True))
    over = parent[at]
    yield {
        "kind": np.zeros(len(at), np.int32),
        "conv_id": least[at],
        "depth": trie.depth[at],
        "n_convs": n_convs[at],
        "n_children": children[at],
        "n_leaves": leaves[at],
        "saved_tokens": saved[at],
        "parent_conv_id": pa.array(least[over], pa.int64(), mask=border[over]),
        "parent_key": [keys.get(p) if border[p] else None for p in over.tolist()],
        "ends": [ending[i] or NO_ENDS for i in at.tolist()],
    }
    # the prefixes of the last sequence that the first one shares go with the first
    sides = [(0, 0)] if len(paths) == 1 else [(0, 0), (len(paths) - 1, int(trie.lcp[1:].min()) + 1)]
    for i, low in sides:
        nodes = trie.at(np.full(int(trie.size[i]) + 1, i), np.arange(int(trie.size[i]) + 1))[low:]
        yield {
            "kind": np.ones(1, np.int32),
            "path": [paths[i]],
            "words": [words[i]],
            "part_from": [low],
            "part_n": [n_convs[nodes]],
            "part_conv_id": [least[nodes]],
            "part_children": [children[nodes]],
            "part_leaves": [leaves[nodes]],
            "part_saved": [saved[nodes]],
            "part_ends": [[ending[k] for k in nodes.tolist()]],
        }


def _columns(made: dict, schema: pa.Schema) -> pa.RecordBatch:
    size = len(made["kind"])
    arrays = [
        (made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], f.type)) if f.name in made else pa.nulls(size, f.type) for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _run_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    paths, ends = table["path"].to_pylist(), table["ends"].to_pylist()
    words = [np.asarray(w, np.int64) for w in table["words"].to_pylist()]
    for made in block_nodes(paths, words, table["n"].to_numpy(), table["conv_id"].to_numpy(), ends):
        yield _columns(made, _BLOCK)


_JOINED = pa.schema(
    [*[(c, pa.int64()) for c in NODE_COLUMNS], ("parent_conv_id", pa.int64()), ("ends", pa.string()), ("key", pa.string()), ("kind", pa.int32())]
)
_JOINED_SQL = ", ".join(f"{c} long" for c in NODE_COLUMNS) + ", parent_conv_id long, ends string, key string, kind int"


def join_borders(rows: list[dict]) -> dict:
    """Nodes that reach an end of some block, from the sorted border sequences of all blocks."""
    paths = sorted({r["path"] for r in rows})
    place = {p: i for i, p in enumerate(paths)}
    words: list = [None] * len(paths)
    for r in rows:
        words[place[r["path"]]] = r["words"]
    trie = Trie(paths)
    count = len(trie.first)
    sums = {c: np.zeros(count, np.int64) for c in ("n", "children", "leaves", "saved")}
    least = np.full(count, np.iinfo(np.int64).max)
    ending = [""] * count
    for r in rows:
        depth = np.arange(r["part_from"], r["part_from"] + len(r["part_n"]))
        nodes = trie.at(np.full(len(depth), place[r["path"]]), depth)
        for c, total in sums.items():
            total[nodes] += np.asarray(r[f"part_{c}"], np.int64)
        least[nodes] = np.minimum(least[nodes], np.asarray(r["part_conv_id"], np.int64))
        for k, e in zip(nodes.tolist(), r["part_ends"], strict=True):
            ending[k] = ending[k] or e
    parent = trie.parents()
    children = sums["children"] + np.bincount(parent[parent >= 0], minlength=count)
    words_at = _words_at(trie, words)
    key = [""] * count
    for i, p in enumerate(paths):
        low, high = int(trie.begin[i]), int(trie.begin[i + 1])
        if high > low:
            key[low:high] = prefix_keys(p, int(trie.size[i]) + 1)[int(trie.depth[low]) :]
    # part sums of leaves and savings hold the complete nodes of a block, nested in every border node above them
    return {
        "kind": np.zeros(count, np.int32),
        "conv_id": least,
        "depth": trie.depth,
        "n_convs": sums["n"],
        "n_children": children,
        "n_leaves": sums["leaves"] + trie.below((children == 0).astype(np.int64)),
        "saved_tokens": sums["saved"] + trie.below((sums["n"] - 1) * words_at),
        "parent_conv_id": pa.array(least[np.maximum(parent, 0)], pa.int64(), mask=parent < 0),
        "ends": [e or NO_ENDS for e in ending],
        "key": key,
    }


def _run_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in b.to_pylist()]
    if rows:
        yield _columns(join_borders(rows), _JOINED)


def prefix_nodes(convs: DataFrame) -> DataFrame:
    """One row a node of the trie over ``conv_id, turns``: ``conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    found = materialize(classes(convs), "classes")
    total = found.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    blocks = max(1, -(-int(total) // BLOCK_TURNS))
    sorted_blocks = found.repartitionByRange(blocks, "path").sortWithinPartitions("path")
    # both kinds of rows come from one cut into blocks, so they are written together
    made = materialize(sorted_blocks.mapInArrow(_run_block, _BLOCK_SQL), "blocks")
    # two rows a block
    borders = materialize(made.where("kind = 1").repartition(1).mapInArrow(_run_borders, _JOINED_SQL), "borders")
    complete = made.where("kind = 0")
    over = bounded_broadcast(borders.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("over_id")))
    nodes = complete.join(over, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "over_id"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    return nodes.select(*names).unionByName(borders.select(*names)).withColumnRenamed("ends", "ends_sha256")
