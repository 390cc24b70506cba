"""Repeated fuzzy passages by collinear chaining of shared k-mers (operator 4).

1. Every document gives winnowed seeds: of each run of ``WINDOW`` consecutive
   k-mers of words the one with the smallest hash.  Two documents that share a
   run of ``SHORT + WINDOW - 1`` words share a seed.  A second level of long seeds
   (four fifths of ``min_words``) is winnowed so that every run of ``min_words``
   holds one: a passage made of lines that stand alone in earlier documents is
   found by the seeds that reach over the lines' borders.  A seed that a
   document holds again also counts under its number there.
2. Seeds travel once, packed: a slice of many documents sends each bucket of
   keys one row of bytes (about ten a seed).  A bucket finds the seeds that two
   documents share; only those become anchors, each occurrence to the first one
   (smallest id, then text hash and position).  A passage in n documents thus
   makes at most two anchors for each occurrence of a seed, never n * n.  A seed
   that a slice holds ``HOT`` times or more sends its bucket only the slice's first
   occurrence; the others meet the first of a salted group of slices, so no key
   fills a bucket.
3. The anchors of a document with one earlier document are chained: both
   positions must grow, gaps cost, and the best predecessor comes from a
   Fenwick tree of prefix maxima.  Long gaps split a chain.  One long seed is
   enough for a chain, of the short ones it takes two.
   Chains inside one that is sure to be a passage are dropped.
4. The words at the chains' ends and gaps are fetched, the gaps are aligned, the
   ends extended, and passages of at least ``min_words`` words with at least
   ``identity`` matched words are returned, without those inside another one of
   their document: one earlier document stands for all that hold them.

Words are runs without blanks, A-Z lower-cased.  Defined results: null and
empty texts have no seeds; a null id takes no part; rows that repeat an id are
documents of their own, told by their text, and equal rows are one; ids that are
not whole numbers are ordered by their hash; texts of any length are taken whole
(a document's seeds are in memory at once); a passage repeated only inside one
document is no result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from avionyx.llm.near_dups import mix
from avionyx.llm.text import WORD, free_name, giving_back, slices
from avionyx.operators.joins import bounded_broadcast
from avionyx.session import materialize

# An anchor's score in a chain; words in a short seed, and how many runs each is the smallest of.
K, SHORT, WINDOW = 5, 5, 2
GAP_COST = 0.04
LONGEST_GAP = 40
BLOCK = 32
REACH = 32
MIN_WORDS, IDENTITY = 45, 0.8
# Characters whose seeds a task packs together, and seeds of a bucket.  Both bound memory; where a
# corpus needs 100,000 buckets or more, larger slices keep the packed rows long.
SLICE_CHARS = 4_000_000
BUCKET_SEEDS = 1_000_000
SEEDS_PER_CHAR = 0.19
# Occurrences in one slice from which a seed is hot, and slices in a salted group.
HOT = 16
SALT_SLICES = 128
# Rows of a batch that are Python objects at a time, and characters hashed together.
PIECE_ROWS, PIECE_CHARS = 256, 2_000_000


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so its powers have inverses among 64-bit numbers


HASHED_BYTES = 1 << 20


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``PIECE_ROWS`` rows, which share their memory."""
    for batch in batches:
        for lo in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(lo, PIECE_ROWS)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


def flat_words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in a row, and the number of words of each text.

    A word's hash is a polynomial of its bytes: the difference of two running
    sums, moved to the word's start.  Sums run over about ``HASHED_BYTES`` at a
    time, or one longer word.
    """
    buffer = np.frombuffer(b" ".join([*raws, b""]), np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], ~_BLANK[buffer], [False]])))
    start, end = edge[::2], edge[1::2]
    words = np.empty(len(start), np.uint64)
    power = back = np.ones(1, np.uint64)
    i = 0
    while i < len(start):
        low = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, low + HASHED_BYTES, side="right")))
        n = int(end[j - 1]) - low
        if n >= len(power):
            power, back = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER[buffer[low : low + n]] + np.uint64(1)) * power[:n], out=sums[1:])
        lo, hi = start[i:j] - low, end[i:j] - low
        words[i:j] = mix((sums[hi] - sums[lo]) * back[lo] + (hi - lo).astype(np.uint64))
        i = j
    cuts = np.cumsum([0, *[len(r) + 1 for r in raws]])
    return words, np.diff(np.searchsorted(start, cuts))


def word_hashes(raws: list[bytes | None]) -> list[np.ndarray]:
    """Per text in UTF-8, a 64-bit hash of every word."""
    flat, counts = flat_words([r or b"" for r in raws])
    return np.split(flat, np.cumsum(counts)[:-1]) if raws else []


def _codes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every run of ``k`` words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    code = np.zeros(n, np.uint64)
    for j in range(k):
        code = code * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n]
    return mix(code + np.uint64(k))


def _winnow(code: np.ndarray, starts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash of each run of ``window`` within a document, the last one of equals.

    ``counts`` hashes of each document begin at ``starts``; of fewer than ``window`` the smallest counts.
    """
    picked = np.zeros(len(code), bool)
    n = max(len(code) - window + 1, 0)
    best, place = code[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window):
        less = code[j : j + n] <= best
        best[less] = code[j : j + n][less]
        place[less] = j
    full = counts >= window
    whole = np.zeros(len(code) + 1, np.int64)
    np.add.at(whole, starts[full], 1)
    np.add.at(whole, starts[full] + counts[full] - window + 1, -1)
    runs = np.flatnonzero(np.cumsum(whole)[:n] > 0)
    picked[runs + place[runs]] = True
    for s, c in zip(starts[~full & (counts > 0)].tolist(), counts[~full & (counts > 0)].tolist(), strict=True):
        picked[s + c - 1 - int(np.argmin(code[s : s + c][::-1]))] = True
    return np.flatnonzero(picked)


def _order(code: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2**40: sorted together with their places, which is faster than ``argsort``."""
    if len(code) >= 1 << 24:
        return np.argsort(code, kind="stable")
    held = np.sort(code.astype(np.uint64) << np.uint64(24) | np.arange(len(code), dtype=np.uint64))
    return (held & np.uint64((1 << 24) - 1)).astype(np.int64)


def _ranks(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Number of earlier equal keys in the same document."""
    own = mix(key + mix(doc.astype(np.uint64)))
    order = _order(own >> np.uint64(24))
    same = np.concatenate([[False], own[order][1:] == own[order][:-1]])
    rank, run = np.zeros(len(key), np.int64), np.arange(len(key))
    rank[order] = run - np.maximum.accumulate(np.where(same, 0, run))
    return rank


def long_size(min_words: int) -> int:
    """Words in a long seed: every run of ``min_words`` holds a winnowed one."""
    return max(SHORT, min_words * 4 // 5)


def all_seeds(raws: list[bytes], min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents, keys, positions and lengths of the seeds of both levels of many texts.

    A later copy of a seed in its document has a numbered key besides.
    """
    words, sizes = flat_words(raws)
    begin = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(raws)), sizes)
    parts = []
    size = long_size(min_words)
    for k, window in ((SHORT, WINDOW), (size, min_words - size + 1)):
        code = _codes(words, k)
        at = _winnow(code, begin, np.maximum(sizes - k + 1, 0), window)
        doc, key = of[at], code[at]
        rank = _ranks(doc, key)
        again = rank > 0
        numbered = mix(key[again] + rank[again].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = np.concatenate([at, at[again]])
        doc = np.concatenate([doc, doc[again]])
        parts.append((doc, np.concatenate([key, numbered]), at - begin[doc], np.full(len(at), k, np.int64)))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def slice_seeds(raws: list[bytes], min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The seeds of a slice, found in pieces of about ``PIECE_CHARS``: only the seeds are held together."""
    found = []
    for lo, hi in slices(raws, PIECE_CHARS):
        doc, *rest = all_seeds(raws[lo:hi], min_words)
        found.append((doc + lo, *rest))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _planes(values: np.ndarray) -> bytes:
    """32-bit values byte by byte, so that the mostly empty high bytes compress."""
    return values.astype(np.int64).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


_PACKED = pa.schema(
    [("bucket", pa.int32()), ("salt", pa.int32()), ("size", pa.int32()), *[(c, pa.binary()) for c in ("docs", "counts", "keys", "places")]]
)


KEY_BYTES = 5


def pack(names: np.ndarray, seeds: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], buckets: int, salts: int) -> pa.RecordBatch:
    """Seeds of a slice (documents, keys, positions, sizes) as one row a bucket, salt and seed length.

    ``names`` holds each document's id and version, in order.  A row lists its
    documents, their numbers of seeds, the keys (40 bits; the bucket holds more)
    and the positions as steps within a document.
    """
    doc, key, pos, size = seeds
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    rows: list[tuple] = []
    # hot seeds: those of the slice's first document go both ways, the others to the salted group only
    held = np.sort(key)
    hot = np.unique(held[HOT - 1 :][held[HOT - 1 :] == held[: len(held) - HOT + 1]]) if len(held) >= HOT else held[:0]
    if len(hot):
        spot = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
        is_hot = hot[spot] == key
        leader = np.full(len(hot), len(names))
        np.minimum.at(leader, spot[is_hot], doc[is_hot])
        group = int(mix(names[:1, 0].astype(np.uint64))[0] % np.uint64(salts))
        there = np.flatnonzero(is_hot)
        _pack_rows(rows, names, doc[there], key[there], pos[there], size[there], (bucket[there] + 1 + 7919 * group) % buckets, group)
        stay = ~is_hot | (doc == leader[spot])
        doc, key, pos, size, bucket = (v[stay] for v in (doc, key, pos, size, bucket))
    _pack_rows(rows, names, doc, key, pos, size, bucket, -1)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PACKED, strict=True)], names=_PACKED.names)


def _pack_rows(rows: list[tuple], names, doc, key, pos, size, bucket, salt: int) -> None:
    code = bucket * 2 + (size > SHORT)
    order = _order(code * len(names) + doc) if len(names) * (int(code.max(initial=0)) + 1) < 1 << 40 else np.lexsort((doc, code))
    code, doc, key, pos, size, bucket = (v[order] for v in (code, doc, key, pos, size, bucket))
    new_row = np.concatenate([[True], np.diff(code) != 0])
    new_doc = new_row | np.concatenate([[True], np.diff(doc) != 0])
    step = np.where(new_doc, pos, pos - np.concatenate([[0], pos[:-1]]))  # a step back is stored modulo 2**32
    low = key.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    cuts = np.append(np.flatnonzero(new_row), len(key)).tolist()
    heads = np.flatnonzero(new_doc)
    counts = np.diff(np.append(heads, len(key))).astype("<u4")
    at = np.searchsorted(heads, cuts).tolist()
    held = names[doc[heads]]
    for lo, hi, dl, dh in zip(cuts[:-1], cuts[1:], at[:-1], at[1:], strict=True):
        rows.append((bucket[lo], salt, size[lo], held[dl:dh].tobytes(), counts[dl:dh].tobytes(), low[lo:hi].tobytes(), _planes(step[lo:hi])))


_LINKS = pa.schema(
    [*[(c, pa.int64()) for c in ("doc_id", "version", "first_id", "first_version")], ("strong", pa.bool_()), ("at", pa.binary())]
)


def link(rows: list[dict]) -> pa.RecordBatch | None:
    """Anchors of the packed rows of one bucket and salt: a row a pair of documents, ``(pos, first pos, size)`` as int32."""
    names, counts, keys, pos, size = [], [], [], [], []
    for r in rows:
        own = np.frombuffer(r["counts"], "<u4").astype(np.int64)
        wide = np.zeros((len(r["keys"]) // KEY_BYTES, 8), np.uint8)
        wide[:, :KEY_BYTES] = np.frombuffer(r["keys"], np.uint8).reshape(-1, KEY_BYTES)
        step = _from_planes(r["places"])
        run = np.cumsum(step)
        heads = np.cumsum(own) - own
        pos.append((run - np.repeat(run[heads] - step[heads], own)) & 0xFFFFFFFF)
        names.append(np.frombuffer(r["docs"], np.int64).reshape(-1, 2))
        counts.append(own)
        keys.append(wide.view("<u8").ravel())
        size.append(np.full(len(step), r["size"], np.int64))
    key, pos, size = np.concatenate(keys), np.concatenate(pos), np.concatenate(size)
    named = np.concatenate(names)
    owner = np.repeat(np.arange(len(named)), np.concatenate(counts))
    order = _order(key)
    same = key[order][1:] == key[order][:-1]
    held = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    if not len(held):
        return None
    key, pos, size, doc, version = key[held], pos[held], size[held], named[owner[held], 0], named[owner[held], 1]
    order = np.lexsort((pos, version, doc, key))
    key, pos, size, doc, version = (v[order] for v in (key, pos, size, doc, version))
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    first = np.repeat(start, np.diff(np.append(start, len(key))))
    apart = np.flatnonzero((doc != doc[first]) | (version != version[first]))
    if not len(apart):
        return None
    first = first[apart]
    cols = [doc[apart], version[apart], doc[first], version[first]]
    order = np.lexsort((pos[apart], *reversed(cols)))
    cols = [c[order] for c in cols]
    new = np.concatenate([[True], np.any([np.diff(c) != 0 for c in cols], axis=0)])
    cuts = np.append(np.flatnonzero(new), len(order))
    at = np.stack([pos[apart], pos[first], size[apart]], axis=1)[order].astype("<i4")
    strong = np.maximum.reduceat(at[:, 2], cuts[:-1]) > SHORT
    raw, width = at.tobytes(), at.itemsize * 3
    packed = [raw[lo * width : hi * width] for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([*[pa.array(c[cuts[:-1]]) for c in cols], pa.array(strong), pa.array(packed, pa.binary())], names=_LINKS.names)


def _links(docs: DataFrame, min_words: int) -> DataFrame:
    """Packed anchors of ``doc_id, version, text``: a row for a pair of documents and a bucket."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(8, -(-int(chars * SEEDS_PER_CHAR) // BUCKET_SEEDS))
    salts = max(1, -(-chars // (SLICE_CHARS * SALT_SLICES)))

    def packed_slice(held: list[tuple]) -> pa.RecordBatch | None:
        held.sort(key=lambda d: d[:2])
        seeds = slice_seeds([d[2] for d in held], min_words)
        return pack(np.array([d[:2] for d in held], np.int64), seeds, buckets, salts) if len(seeds[0]) else None

    @giving_back
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in _pieces(batches):
            for d, v, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held.append((d, v, raw))
                size += len(raw)
                if size >= SLICE_CHARS:
                    made = packed_slice(held)
                    held, size = [], 0
                    if made is not None:
                        yield made
        made = packed_slice(held) if held else None
        if made is not None:
            yield made

    @giving_back
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in _pieces(batches):
            raws = {c: batch.column(c) for c in ("docs", "counts", "keys", "places")}
            for i, (bucket, salt, size) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("bucket", "salt", "size")], strict=True)):
                r = {"size": size, **{c: held[i].as_buffer() for c, held in raws.items()}}  # not copied
                group = (bucket, salt)
                if group != now and rows:
                    found = link(rows)
                    if found is not None:
                        yield found
                    rows = []
                now = group
                rows.append(r)
        found = link(rows) if rows else None
        if found is not None:
            yield found

    raw = docs.where("text is not null").select("doc_id", "version", F.col("text").cast("binary"))
    packed = raw.mapInArrow(send, "bucket int, salt int, size int, docs binary, counts binary, keys binary, places binary")
    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "salt")
    return dealt.mapInArrow(meet, "doc_id long, version long, first_id long, first_version long, strong boolean, at binary")


def chain(anchors: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Collinear chains of ``(x, y)`` anchors, best first, each anchor in one chain.

    score(j) = K + max(0, max over i with x_i < x_j and y_i < y_j of
    score(i) - GAP_COST * ((x_j - x_i) + (y_j - y_i))).  The gap cost splits
    into a part of i and a part of j, so a Fenwick tree over the ranks of y
    that holds prefix maxima answers each step in logarithmic time.
    """
    points = sorted(set(anchors))
    if len({y - x for x, y in points}) == 1:  # one diagonal: each follows the one before, unless the gap is long
        cuts = [i for i in range(1, len(points)) if points[i][0] - points[i - 1][0] > LONGEST_GAP + K]
        return [points[lo:hi] for lo, hi in zip([0, *cuts], [*cuts, len(points)], strict=True)]
    ranks = {y: r for r, y in enumerate(sorted({y for _, y in points}), 1)}
    size = len(ranks)
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)
    score, back = [0.0] * len(points), [-1] * len(points)
    waiting: list[tuple[int, float, int]] = []
    last_x = None
    for j, (x, y) in enumerate(points):
        if x != last_x:  # anchors at one x can't follow each other
            for r, value, i in waiting:
                while r <= size:
                    if value > tree[r][0]:
                        tree[r] = (value, i)
                    r += r & -r
            waiting, last_x = [], x
        best, r = (-1e18, -1), ranks[y] - 1
        while r > 0:
            if tree[r][0] > best[0]:
                best = tree[r]
            r -= r & -r
        gain = best[0] - GAP_COST * (x + y)
        score[j] = K + max(0.0, gain)
        back[j] = best[1] if gain > 0 else -1
        waiting.append((ranks[y], score[j] + GAP_COST * (x + y), j))
    used, out = [False] * len(points), []
    for j in sorted(range(len(points)), key=lambda i: -score[i]):
        run = []
        while j >= 0 and not used[j]:
            used[j] = True
            run.append(points[j])
            j = back[j]
        part: list[tuple[int, int]] = []
        for p in reversed(run):
            if part and max(p[0] - part[-1][0], p[1] - part[-1][1]) > LONGEST_GAP + K:
                out.append(part)
                part = []
            part.append(p)
        if part:
            out.append(part)
    return out


def uncovered(chains: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """The chains, without those in whose range a longer kept one has as many anchors."""
    kept: list[list[tuple[int, int]]] = []
    held: dict[int, list[np.ndarray]] = {}  # by the blocks that a kept chain reaches
    for part in sorted(chains, key=lambda c: -len(c)):
        lo, hi = part[0][0], part[-1][0]
        if not any(np.searchsorted(x, hi, side="right") - np.searchsorted(x, lo) >= len(part) for x in held.get(lo // BLOCK, ())):
            kept.append(part)
            x = np.array([a for a, _ in part])
            for block in range(lo // BLOCK, hi // BLOCK + 1):
                held.setdefault(block, []).append(x)
    return kept


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _extend(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Words by which two equal-direction tails extend a match, and how many match (x-drop)."""
    n = min(len(x), len(y))
    if not n:
        return 0, 0
    same = x[:n] == y[:n]
    gain = np.cumsum(np.where(same, 1, -2))
    stop = np.flatnonzero(gain < np.maximum.accumulate(np.maximum(gain, 0)) - 8)
    gain = gain[: stop[0]] if len(stop) else gain
    if not len(gain) or gain.max() <= 0:
        return 0, 0
    best = len(gain) - 1 - int(np.argmax(gain[::-1]))
    return best + 1, int(same[: best + 1].sum())


def asked_blocks(spots: list[int], gaps: list[bool]) -> list[int]:
    """Blocks that hold the words at a chain's ends and in its gaps; ``gaps[i]`` tells of one after anchor i."""
    spans = [(max(spots[0] - REACH, 0), spots[0] + SHORT), (spots[-1], spots[-1] + SHORT + REACH)]
    spans += [(a, b) for a, b, gap in zip(spots, spots[1:], gaps, strict=False) if gap]
    return sorted({block for lo, hi in spans for block in range(lo // BLOCK, hi // BLOCK + 1)})


def joined(points: list[tuple[int, int]]) -> list[bool]:
    """For each anchor but the last, whether words lie between it and the next one that it does not vouch for."""
    return [b[0] - a[0] != b[1] - a[1] or b[0] - a[0] > SHORT for a, b in zip(points, points[1:])]


def spread(blocks: list[tuple[int, bytes]]) -> tuple[np.ndarray, int]:
    """Words by position from the first block on, 0 where no block was asked, and the first position."""
    at = blocks[0][0] * BLOCK
    out = np.zeros((blocks[-1][0] + 1) * BLOCK - at, np.uint32)
    end = at
    for block, raw in blocks:
        held = np.frombuffer(raw, "<u4")
        out[block * BLOCK - at : block * BLOCK - at + len(held)] = held
        end = block * BLOCK + len(held)
    return out[: end - at], at


def align(points: list[tuple[int, int]], x: np.ndarray, x0: int, y: np.ndarray, y0: int) -> tuple[int, int, int, int, int]:
    """Align a chain; ``x`` and ``y`` hold the words from ``x0`` and ``y0`` on, at least those at its ends and in its gaps.

    Returns start and end in both documents and the matched words.  The words
    of an anchor match by its key.
    """
    held = [(a - x0, b - y0) for a, b in points]
    px, py = held[0]
    left, matched = _extend(x[max(px - REACH, 0) : px][::-1], y[max(py - REACH, 0) : py][::-1])
    ex, ey = px, py
    for a, b in held:
        if a < ex or b < ey:  # overlaps what is aligned: only its new tail on the same diagonal
            if a - ex != b - ey or a + SHORT <= ex:
                continue
            matched += a + SHORT - ex
        else:
            gx, gy = x[ex:a], y[ey:b]
            if len(gx) == len(gy):
                matched += int((gx == gy).sum())
            elif len(gx) and len(gy):
                matched += lcs(gx.tolist(), gy.tolist())
            matched += SHORT
        ex, ey = a + SHORT, b + SHORT
    right, more = _extend(x[ex : ex + REACH], y[ey : ey + REACH])
    return x0 + px - left, x0 + ex + right, y0 + py - left, y0 + ey + right, matched + more


_PAIR = ["doc_id", "version", "first_id", "first_version"]


def inner_chains_dropped(chains: list[tuple], min_words: int, identity: float) -> list[tuple]:
    """Chains ``(first document, points)`` of one document, without those inside a sure one.

    Sure is a chain whose anchors alone cover ``identity`` of a range of
    ``min_words`` or more: it will be a passage, and holds what the inner ones
    could give.
    """

    def sure(points: list[tuple[int, int]]) -> bool:
        size = max(points[-1][0] - points[0][0], points[-1][1] - points[0][1]) + SHORT
        covered = SHORT + sum(min(b[0] - a[0], b[1] - a[1], SHORT) for a, b in zip(points, points[1:]))
        return size >= min_words and covered >= identity * size

    kept, end = [], -1
    for first, points in sorted(chains, key=lambda c: (c[1][0][0], -c[1][-1][0], not sure(c[1]), c[0])):
        if points[-1][0] > end:
            kept.append((first, points))
            if sure(points):
                end = points[-1][0]
    return kept


def _chains(links: DataFrame, min_words: int, identity: float) -> DataFrame:
    """Chains of each document with earlier documents, as flat anchor lists.

    A document has at most a few anchors a seed, so its row is bounded by its length.
    """
    anchors = F.struct("first_id", "first_version", "strong", "at")
    grouped = links.groupBy("doc_id", "version").agg(F.collect_list(anchors).alias("a")).select("doc_id", "version", "a.first_id", "a.first_version", "a.strong", "a.at")

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            rows: list[tuple] = []
            for doc, version, firsts, versions, strongs, ats in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                pairs: dict[tuple[int, int], list[bytes]] = {}
                strong: set[tuple[int, int]] = set()
                for f, v, s, at in zip(firsts, versions, strongs, ats, strict=True):
                    pairs.setdefault((f, v), []).append(at)
                    if s:
                        strong.add((f, v))
                found = []
                for first, parts in pairs.items():
                    raw = b"".join(parts)
                    if len(raw) > 12 or first in strong:
                        anchors = np.frombuffer(raw, "<i4").reshape(-1, 3)
                        # a long seed counts as the short ones at its two ends
                        reach = anchors[:, :2] + anchors[:, 2:] - SHORT
                        points = list(map(tuple, np.concatenate([anchors[:, :2], reach]).tolist()))
                        found += [(first, c) for c in uncovered([c for c in chain(points) if len(c) > 1])]
                for first, part in inner_chains_dropped(found, min_words, identity):
                    x, y = [a for a, _ in part], [b for _, b in part]
                    gaps = joined(part)
                    rows.append((doc, version, *first, x, y, asked_blocks(x, gaps), asked_blocks(y, gaps)))
            names = [*_PAIR, "x", "y", "x_blocks", "y_blocks"]
            cols = list(zip(*rows, strict=True)) or [[]] * len(names)
            kinds = [*[pa.int64()] * 4, *[pa.list_(pa.int32())] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    kinds = ", ".join([*[f"{c} long" for c in _PAIR], *[f"{c} array<int>" for c in ("x", "y", "x_blocks", "y_blocks")]])
    return grouped.mapInArrow(run, kinds).withColumn("chain", F.xxhash64(*_PAIR, F.col("x")[0], F.col("y")[0]))


def _blocks(docs: DataFrame) -> DataFrame:
    """``doc_id, version, block, words``: word hashes (32 bits each) of the asked ``blocks`` of BLOCK words."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            ids, versions, raws, asked = (c.to_pylist() for c in batch.columns)
            for lo, hi in slices(raws):
                rows: list[tuple] = []
                for d, v, w, blocks in zip(ids[lo:hi], versions[lo:hi], word_hashes(raws[lo:hi]), asked[lo:hi], strict=True):
                    short = (w >> np.uint64(32)).astype("<u4")
                    rows += [(d, v, b, short[b * BLOCK : (b + 1) * BLOCK].tobytes()) for b in blocks if b * BLOCK < len(short)]
                cols = list(zip(*rows, strict=True)) or [[]] * 4
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "version", "block", "words"]
                )

    return docs.mapInArrow(run, "doc_id long, version long, block int, words binary")


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, identity: float = IDENTITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per longest passage of a document that an earlier document holds too.

    ``doc_id, start_word, end_word`` (end exclusive), the earlier document and
    its range ``first_id, first_start, first_end``, ``matched_words``, and
    ``text_hash`` (xxhash64 of the text that the range counts in).
    """
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    kind = docs.schema[id_col].dataType.simpleString()
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    number = key.cast("long") if whole else F.xxhash64(key)
    asked = docs.where(key.isNotNull())
    texts = asked.select(number.alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))
    spans = _passages(texts, min_words, identity)
    if whole:
        return spans.withColumns({c: F.col(c).cast(kind) for c in ("doc_id", "first_id")}) if kind != "bigint" else spans
    names = asked.select(number.alias("number"), key.alias("name")).distinct()
    for c in ("doc_id", "first_id"):
        spans = spans.join(names.withColumnRenamed("number", c), c).drop(c).withColumnRenamed("name", c)
    return spans.select(*_SPAN_NAMES)


def _passages(docs: DataFrame, min_words: int, identity: float) -> DataFrame:
    chains = materialize(_chains(_links(docs, min_words), min_words, identity), "chains")
    asked = chains.select("chain", "doc_id", "version", F.lit(0).alias("side"), F.explode("x_blocks").alias("block")).unionAll(
        chains.select("chain", "first_id", "first_version", F.lit(1), F.explode("y_blocks"))
    )
    # each document sends the blocks that some chain asks for
    wanted = materialize(asked.groupBy("doc_id", "version").agg(F.collect_set("block").alias("blocks")), "wanted")
    texts = docs.join(bounded_broadcast(wanted), ["doc_id", "version"])
    blocks = _blocks(texts.select("doc_id", "version", F.col("text").cast("binary"), "blocks"))
    # equal rows of documents give equal blocks, of which a set keeps one
    words = (
        asked.join(blocks, ["doc_id", "version", "block"])
        .groupBy("chain")
        .agg(F.sort_array(F.collect_set(F.struct("side", "block", "words"))).alias("b"))
        .select("chain", *[F.col(f"b.{c}").alias(c) for c in ("side", "block", "words")])
    )
    both = chains.join(words, "chain").select("doc_id", "first_id", "x", "y", "version", "side", "block", "words")

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            out: list[tuple] = []
            for d, f, xs, ys, version, side, block, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                cut = side.index(1)
                x, x0 = spread(list(zip(block[:cut], raw[:cut], strict=True)))
                y, y0 = spread(list(zip(block[cut:], raw[cut:], strict=True)))
                s, e, fs, fe, matched = align(list(zip(xs, ys, strict=True)), x, x0, y, y0)
                if e - s >= min_words and matched >= identity * max(e - s, fe - fs):
                    out.append((d, s, e, f, fs, fe, matched, version))
            cols = list(zip(*out, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=_SPAN_NAMES)

    spans = both.mapInArrow(run, ", ".join(f"{n} long" for n in _SPAN_NAMES))
    # a passage inside another one of its document adds nothing
    order = Window.partitionBy("doc_id", "text_hash").orderBy("start_word", F.col("end_word").desc(), "first_id", "first_start", "first_end", F.col("matched_words").desc())
    reached = F.max("end_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return spans.withColumn("reached", reached).where("reached is null or reached < end_word").drop("reached")


_SPAN_NAMES = ["doc_id", "start_word", "end_word", "first_id", "first_start", "first_end", "matched_words", "text_hash"]


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and the blanks that follow them."""
    starts = [m.start() for m in WORD.finditer(text)]
    out, at = [], 0
    for lo, hi in sorted(spans):
        a = starts[lo] if lo < len(starts) else len(text)
        b = starts[hi] if hi < len(starts) else len(text)
        if b > at:
            out.append(text[at : max(a, at)])
            at = b
    out.append(text[at:])
    return "".join(out)


def cut_repeats(docs: DataFrame, min_words: int = MIN_WORDS, identity: float = IDENTITY, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every repeated passage cut from all documents but the first that holds it.

    Rows left without a word are dropped; rows without a repeat keep their
    text unchanged.  ``size_col``, if present, is set to the new length.
    """
    spans = (
        repeated_passages(docs, min_words, identity, id_col, text_col)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    )
    key, version, cuts = (free_name(docs, n) for n in ("cut_id", "cut_hash", "cuts"))
    spans = spans.select(F.col("doc_id").alias(key), F.col("text_hash").alias(version), F.col("spans").alias(cuts))
    same = (docs[f"`{id_col}`"] == spans[key]) & (F.xxhash64(docs[f"`{text_col}`"]) == spans[version])
    joined = docs.join(spans, same, "left").drop(key, version)
    names = list(docs.columns)
    at = names.index(text_col)
    size_at = names.index(size_col) if size_col in names else None

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column(len(names)).to_pylist()
            columns = list(batch.columns[: len(names)])
            rows = [i for i, c in enumerate(cuts) if c]
            if rows:
                texts = columns[at].to_pylist()
                keep = [True] * len(texts)
                sizes = columns[size_at].to_pylist() if size_at is not None else None
                for i in rows:
                    if texts[i] is None:
                        continue
                    texts[i] = cut_words(texts[i], [(c["start_word"], c["end_word"]) for c in cuts[i]])
                    keep[i] = WORD.search(texts[i]) is not None
                    if sizes is not None:
                        sizes[i] = len(texts[i])
                columns[at] = pa.array(texts, columns[at].type)
                if sizes is not None:
                    columns[size_at] = pa.array(sizes, columns[size_at].type)
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))
            else:
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, docs.schema)
