"""Ranked lexical search by the Best Position Algorithm (operator 13).

1. One pass over the documents cuts terms from whole texts, and keeps per
   document its length and the counts of the terms that some query asks for.
   This narrow table is written; it gives the number of documents N, their terms
   L and each term's document frequency.
2. Tasks build segments of at most ``SEGMENT_POSTINGS`` postings: per term an
   impact list, best first.  For each query the lists are read side by side in
   growing steps.  Every document met is scored in full by direct accesses to
   the other lists, which mark its positions there as seen.  A list's best
   position is the end of its contiguous run of seen positions, and no unseen
   document can score above the sum of the impacts that follow the best
   positions.  Reading stops once that sum is strictly below the k-th score, so
   ties are always met.  The k best of a task's earlier segments stand as the
   first k-th score of the next.
3. The k best of each task are ranked by query; Spark prunes them to k before
   the shuffle.

Queries go out in blocks of bounded size, each against all documents.  All
arithmetic but a term's weight is exact in integers.

Defined results: a document without a term (null or empty text) is not counted
and never ranked, nor is one of score 0; null ids come last among equal scores;
repeated rows are ranked each; a query without a term, or whose terms occur in
no document, has no rows; repeated queries are answered each; empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from avionyx.session import materialize

SEGMENT_POSTINGS = 2_000_000
FIRST_STEP = 16
DIRECT_ACCESSES = 2_000_000
BLOCK_ITEMS = 2_048
BLOCK_CHARS = 4_000_000

_TERM = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
# every byte of a term stays (A-Z lower-cased), every other one becomes a blank
_FOLD = bytes(b if b in _TERM else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(raw: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8: runs of ASCII letters, digits and all other letters beyond ASCII."""
    return raw.translate(_FOLD).split() if raw else []


class Queries:
    """A block of queries over a shared vocabulary."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.terms: list[np.ndarray] = []
        self.repeats: list[np.ndarray] = []
        for item, text in items:
            asked = Counter(terms_of(text.encode() if text else None))
            if asked:
                self.ids.append(item)
                self.terms.append(np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in asked], np.int64))
                self.repeats.append(np.array(list(asked.values()), np.int64))


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], kind: str) -> DataFrame:
    """``doc_id, n, terms, counts`` of the documents that have a term; ``terms`` are those of the vocabulary, ascending."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most the terms of one block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for batch in batches:
            rows: list[int] = []
            sizes: list[int] = []
            ends, terms, counts = [0], [], []
            for i, raw in enumerate(batch.column(1)):
                found = terms_of(raw.as_py())
                if found:
                    held = Counter(map(number, found))
                    held.pop(None, None)
                    for t in sorted(held):
                        terms.append(t)
                        counts.append(held[t])
                    ends.append(len(terms))
                    rows.append(i)
                    sizes.append(len(found))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(counts, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, counts array<long>")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Segment:
    """Impact lists of some documents.

    Postings are kept twice: ordered by (document, term) for direct accesses, and
    by term with the best impact first.  ``place`` leads from the first order to
    the second.
    """

    def __init__(self, sizes: list[int], ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, n_terms: int, n_docs: int, all_terms: int):
        doc = np.repeat(np.arange(len(sizes)), np.diff(ends))
        length = np.array([25 + 75 * n * n_docs // all_terms for n in sizes], np.int64)
        self.n_terms = n_terms
        self.key = doc * n_terms + terms
        self.impact = 1_000_000_000 * counts // (1000 * counts + 8 * length[doc])
        by_list = np.lexsort((doc, -self.impact, terms))
        self.place = np.empty(len(by_list), np.int64)
        self.place[by_list] = np.arange(len(by_list))
        self.list_doc, self.list_impact = doc[by_list], self.impact[by_list]
        self.start = np.searchsorted(terms[by_list], np.arange(n_terms + 1))
        self.seen = np.zeros(len(by_list) + 1, bool)

    def best(self, terms: np.ndarray, factor: np.ndarray, floor: int, offer) -> int:
        """Score documents for one query, each at most once, until no other can reach the k-th score.

        ``factor`` is each term's weight times its repeats; ``offer`` takes
        arrays of documents and scores and returns the k-th score so far.
        Returns the positions read by sorted access.
        """
        starts, ends = self.start[terms], self.start[terms + 1]
        some = ends > starts
        if not some.all():
            terms, factor, starts, ends = terms[some], factor[some], starts[some], ends[some]
        if not len(terms):
            return 0
        best = starts.copy()  # first position that is not seen, a list
        marked: list[np.ndarray] = []
        scored = np.zeros(0, np.int64)
        depth, step, read = 0, FIRST_STEP, 0
        padded = np.append(self.list_impact, 0)
        while True:
            ahead = np.where(best < ends, padded[np.minimum(best, len(padded) - 1)], 0)
            bound = int((factor * ahead).sum())
            if bound < floor or not bound:
                break
            lo, hi = np.minimum(starts + depth, ends), np.minimum(starts + depth + step, ends)
            width = hi - lo
            read += int(width.sum())
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(int(width.sum()))
            met = np.setdiff1d(self.list_doc[at], scored)
            if len(met):
                scored = np.union1d(scored, met)
                for part in np.array_split(met, -(-len(met) * len(terms) // DIRECT_ACCESSES)):
                    # direct accesses: every list of the query at every document met
                    want = part[:, None] * self.n_terms + terms[None, :]
                    found = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
                    held = self.key[found] == want
                    scores = (np.where(held, self.impact[found], 0) * factor).sum(axis=1)
                    spots = self.place[found[held]]
                    self.seen[spots] = True
                    marked.append(spots)
                    floor = max(floor, offer(part, scores))
            for j in range(len(terms)):
                b, end = int(best[j]), int(ends[j])
                while b < end:
                    run = self.seen[b : min(b + 1024, end)]
                    gap = int(np.argmin(run))
                    if not run[gap]:
                        b += gap
                        break
                    b += len(run)
                best[j] = b
            depth, step = depth + step, step * 2
        for spots in marked:
            self.seen[spots] = False
        return read


def _order(doc_id) -> tuple:
    return (doc_id is None, doc_id)


class _Last:
    """Sorts backwards, so that a heap's top is the worst of equal scores."""

    __slots__ = ("of",)

    def __init__(self, of: tuple):
        self.of = of

    def __lt__(self, other: _Last) -> bool:
        return other.of < self.of


def search_block(counted: DataFrame, queries: Queries, n_docs: int, all_terms: int, k: int, kind: str) -> DataFrame:
    """``query, doc_id, score``: the k best of each task for each query of the block."""
    wanted = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = np.zeros(len(queries.vocabulary), np.int64)
    for r in wanted.collect():  # one row a term of the block
        weight[r["term"]] = term_weight(n_docs, r["df"])
    sent = counted.sparkSession.sparkContext.broadcast((weight, queries.terms, queries.repeats))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, terms, repeats = sent.value
        tops: list[list[tuple]] = [[] for _ in terms]  # heaps of (score, _Last(order of id), id)
        kinds = None

        def search(parts: list[tuple]) -> None:
            ids = [d for part in parts for d in part[0]]
            sizes = [n for part in parts for n in part[1]]
            ends = np.concatenate([[0], np.cumsum(np.concatenate([part[2] for part in parts]))])
            segment = Segment(
                sizes, ends, np.concatenate([part[3] for part in parts]), np.concatenate([part[4] for part in parts]), len(weight), n_docs, all_terms
            )
            for q, top in enumerate(tops):

                def offer(docs: np.ndarray, scores: np.ndarray, top=top) -> int:
                    least = top[0][0] if len(top) == k else 1
                    for i in np.flatnonzero(scores >= least):
                        doc_id = ids[docs[i]]
                        entry = (int(scores[i]), _Last(_order(doc_id)), doc_id)
                        if len(top) < k:
                            heapq.heappush(top, entry)
                        elif top[0][:2] < entry[:2]:
                            heapq.heapreplace(top, entry)
                    return top[0][0] if len(top) == k else 0

                segment.best(terms[q], weight[terms[q]] * repeats[q], top[0][0] if len(top) == k else 0, offer)

        parts: list[tuple] = []
        held = 0
        for batch in batches:
            kinds = batch.column(0).type
            lists, counts = batch.column(2), batch.column(3)
            sizes = np.diff(lists.offsets.to_numpy())
            parts.append(
                (batch.column(0).to_pylist(), batch.column(1).to_pylist(), sizes, lists.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy())
            )
            held += int(sizes.sum())
            if held >= SEGMENT_POSTINGS:
                search(parts)
                parts, held = [], 0
        if held:
            search(parts)
        rows = [(q, doc_id, score) for q, top in enumerate(tops) for score, _, doc_id in top]
        if rows:
            q, doc_id, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), pa.array(doc_id, kinds), pa.array(score, pa.int64())], names=["query", "doc_id", "score"]
            )

    return counted.mapInArrow(run, f"query int, doc_id {kind}, score long")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item its k documents of the highest scores."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = items.schema[item_col].dataType.simpleString()
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    size = asked.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    n_blocks = max(1, -(-int(size[0]) // BLOCK_ITEMS), -(-int(size[1] or 0) // BLOCK_CHARS))
    if n_blocks > 1:
        asked = materialize(asked.withColumn("block", F.floor(F.rand(13) * n_blocks)), "queries")
    out = None
    for b in range(n_blocks):
        block = asked.where(F.col("block") == b) if n_blocks > 1 else asked
        queries = Queries([(r["item_id"], r["text"]) for r in block.collect()])  # a block of bounded size
        counted = materialize(term_counts(texts, queries.vocabulary, kind), "term-counts")
        n_docs, all_terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        best = search_block(counted, queries, n_docs, all_terms or 1, k, kind)
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(queries.ids)), f"query int, item_id {item_kind}")
        found = ranked.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out
