"""Benchmark decontamination by latent semantic retrieval (operator 2).

1. Every text becomes word codes (16-bit hashes of lower-cased words); the
   codes are written once and all later passes read them.
2. All non-overlapping passages of the corpus form a TF-IDF matrix A over hashed
   features, rows of length one.  A randomised SVD finds its leading right
   singular vectors: with a block X (first a random one, then an orthonormal
   base of what that gave) each task adds up its share of A' (A X), a
   feature-by-column block of fixed size, and the second sum gives the singular
   vectors and values by the Nystroem formula.
3. Benchmark items (in blocks of bounded size) and windows of every document, at
   a geometric set of window lengths, are projected on those vectors, each
   divided by its singular value.  Windows whose cosine with an item reaches
   ``cosine`` are candidates.
4. A candidate is a hit if the longest common subsequence with the item covers
   ``verbatim`` of its words, or ``paraphrase`` of them while the item's answer
   (its last sentence, or last third if there is one sentence) is found there
   in order too.

5. Items of fewer than ``LEAST_WORDS`` words have too little to be told by their
   words: they are looked up verbatim, as a run of whole words, with an
   Aho-Corasick automaton over the texts.  At an end written in a script without
   blanks the run may also be part of a longer one.

Defined results: null and empty texts match nothing; an item without a word is
not found.  An item longer than the largest window is asked for in pieces, and
judged whole.  ``near_word`` counts words from the start of the document, however
long.  Repeated items and rows give repeated results only per distinct
``(doc_id, item_id)``; of hits with equal shares the one that holds more of the
answer counts, then the first.  Ids and item ids may have any type.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from avionyx.llm.substrings import lcs
from avionyx.llm.text import free_name, giving_back, slices
from avionyx.session import materialize

FEATURES = 1 << 13
RANK, OVERSAMPLE = 96, 16
PASSAGE = 48
# Window lengths in words, and how far apart their windows start: a quarter of
# the length at most, and a divisor of GRID.
STEPS = {8: 2, 11: 2, 16: 4, 23: 4, 32: 8, 45: 8, 64: 16}
SCALES = tuple(STEPS)
GRID, PAD = 16, 64
REPEAT_REACH, REPEAT_WEIGHT = 32, 0.3
LEAST_WORDS = 8
COSINE, VERBATIM, PARAPHRASE, ANSWER = 0.45, 0.75, 0.6, 0.8
CACHE_WORDS = 400_000
BLOCK_ITEMS, BLOCK_CHARS = 2048, 4_000_000
RUN_WORDS = 1 << 14
SVD_WORDS = 1 << 11
PIECE_WORDS = 40 * PASSAGE  # a long document is taken in pieces of whole passages
SEED = 7
HIT = ("doc_id", "item_id", "near_word", "lcs_share", "answer_share")

TOKEN = re.compile(r"\w+")
# Scripts written without blanks: Thai and Lao, Myanmar, Khmer, kana, Han.
BLANK_FREE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
SHORTEST_CUT = 3


class _Codes(dict):
    """16-bit codes of words, kept for the words that a task has seen so far."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        code = self[word] = zlib.crc32(word.encode()) >> 16
        return code


_CODES = _Codes()


def word_codes(texts: list[str | None]) -> list[np.ndarray]:
    """16-bit codes of the lower-cased words of each text."""
    code = _CODES.__getitem__
    out = []
    for text in texts:
        words = TOKEN.findall(text.lower()) if text else []
        out.append(np.fromiter(map(code, words), "<u2", len(words)))
    return out


def forget_words() -> None:
    """Called at the end of a task: the worker does other work next."""
    _CODES.clear()


def _coded(docs: DataFrame, id_type: str) -> DataFrame:
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                codes = [c.tobytes() for c in word_codes(texts[lo:hi])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(codes, pa.binary())], names=["doc_id", "codes"]
                )
        forget_words()

    return docs.mapInArrow(run, f"doc_id {id_type}, codes binary")


def _runs(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and passage numbers of bounded runs of passages.

    A run is small enough for its working arrays to stay in the processor's
    cache; a long document makes several.
    """
    codes: list[np.ndarray] = []
    passages: list[np.ndarray] = []
    held, at = 0, 0
    for batch in batches:
        for value in batch.column(column):
            whole = np.frombuffer(value.as_buffer(), "<u2")
            for lo in range(0, len(whole), PIECE_WORDS):
                c = whole[lo : lo + PIECE_WORDS]
                part = np.arange(len(c)) // PASSAGE
                codes.append(c & (FEATURES - 1))
                passages.append(part + at)
                at += int(part[-1]) + 1
                held += len(c)
                if held >= SVD_WORDS:
                    yield np.concatenate(codes), np.concatenate(passages)
                    codes, passages, held, at = [], [], 0, 0
    if held:
        yield np.concatenate(codes), np.concatenate(passages)


def _entries(f: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passage, feature and count of the entries of the term matrix, by passage, then feature."""
    key = np.sort(p.astype(np.uint64 if int(p[-1]) >= 2**32 // FEATURES else np.uint32) * FEATURES + f)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key // FEATURES).astype(np.int64), (key % FEATURES).astype(np.uint16), times


def passage_frequencies(coded: DataFrame) -> tuple[np.ndarray, int]:
    """In how many passages each feature occurs, and the number of passages."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, np.int64)
        for f, p in _runs(batches):
            _, features, _ = _entries(f, p)
            total[:-1] += np.bincount(features, minlength=FEATURES)
            total[-1] += int(p[-1]) + 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["feature", "n"])

    counts = coded.select("codes").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    out = np.zeros(FEATURES + 1, np.int64)
    for r in counts.collect():  # one row per feature at most
        out[r["feature"]] = r["n"]
    return out[:-1], int(out[-1])


def _weights(p: np.ndarray, f: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of the entries; the row of a passage has length one."""
    w = times * idf[f]
    length = np.sqrt(np.bincount(p, weights=w * w))
    return (w / np.maximum(length, 1e-12)[p]).astype(np.float32)


def _gram_times(coded: DataFrame, idf: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``A' (A start)`` for the TF-IDF matrix A; each task adds up its share."""
    width = start.shape[1]
    spark = coded.sparkSession
    sent = spark.sparkContext.broadcast((start, idf))

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, idf = sent.value
        total = np.zeros((FEATURES, width), np.float32)
        seen = False
        for words, passages in _runs(batches):
            seen = True
            p, f, times = _entries(words, passages)
            here, column = np.unique(f, return_inverse=True)
            # the few passages of a run over the features they hold: small and dense
            a = np.zeros((int(p[-1]) + 1, len(here)), np.float32)
            a[p, column] = _weights(p, f, times, idf)
            total[here] += a.T @ (a @ x[here])
        if seen:
            step = 256
            parts = [(b, total[b : b + step].tobytes()) for b in range(0, FEATURES, step)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in parts], pa.int32()), pa.array([v for _, v in parts], pa.binary())], names=["part", "block"]
            )

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column("block"):
                v = np.frombuffer(value.as_buffer(), np.float32).astype(np.float64)
                total = v if total is None else total + v
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["part", "block"])

    # every part gets one block of fixed size from each task; they are added up in a stream
    sums = coded.select("codes").mapInArrow(run, "part int, block binary").groupBy("part").applyInArrow(add, "part int, block binary")
    b = np.zeros((FEATURES, width))
    for r in sums.collect():  # FEATURES x width numbers in all
        v = np.frombuffer(r["block"], np.float32).reshape(-1, width)
        b[r["part"] : r["part"] + len(v)] = v
    sent.unpersist()
    return b


def leading_vectors(coded: DataFrame, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (features x rank) and singular values of the TF-IDF matrix."""
    width = RANK + OVERSAMPLE
    start = np.random.default_rng(SEED).standard_normal((FEATURES, width)).astype(np.float32)
    # a power step: on a flat spectrum one pass from a random block is 10 % low
    start = np.linalg.qr(_gram_times(coded, idf, start))[0].astype(np.float32)
    b = _gram_times(coded, idf, start)
    # Nystroem: A'A ~ b (x'b)^-1 b', computed stably with a small shift
    x = start.astype(np.float64)
    shift = 1e-6 * np.linalg.norm(b)
    b = b + shift * x
    core = x.T @ b
    root = np.linalg.cholesky((core + core.T) / 2 + 1e-9 * np.trace(core) / width * np.eye(width))
    vectors, values, _ = np.linalg.svd(np.linalg.solve(root, b.T).T, full_matrices=False)
    return vectors[:, :RANK], np.sqrt(np.maximum(values[:RANK] ** 2 - shift, 1e-12))


def answer_of(text: str, codes: np.ndarray) -> np.ndarray:
    """Codes of the item's last sentence, or of its last third if it is one sentence."""
    sentences = [s for s in re.split(r"[.!?\n]+", text) if TOKEN.search(s)]
    n = len(TOKEN.findall(sentences[-1])) if len(sentences) > 1 else 0
    return codes[-max(n, -(-len(codes) // 3), 4) :]


def item_queries(items: list[tuple[object, str]]) -> list[tuple[object, int, np.ndarray, np.ndarray, np.ndarray, int]]:
    """``(item_id, scale, piece, whole, answer, lead)``; an item longer than the largest scale asks in
    pieces, each with the ``lead`` words of the item before it."""
    out = []
    for (item, text), codes in zip(items, word_codes([t for _, t in items]), strict=True):
        if len(codes) < LEAST_WORDS:
            continue
        pieces = -(-len(codes) // SCALES[-1])
        for part in np.array_split(np.arange(len(codes)), pieces):
            scale = min(SCALES, key=lambda s: abs(np.log(s / len(part))))
            out.append((item, scale, codes[part], codes, answer_of(text, codes), int(part[0])))
    return out


def _plain(text: str) -> str:
    """The lower-cased words between single blanks."""
    return f" {' '.join(TOKEN.findall(text.lower()))} "


def short_patterns(items: list[tuple[object, str]], shortest: int) -> dict[str, list]:
    """The runs to look up for items of ``shortest`` to ``LEAST_WORDS`` - 1 words, and whose they are."""
    out = defaultdict(list)
    for item, text in items:
        plain = _plain(text)
        if max(shortest, 1) <= len(plain.split()) < LEAST_WORDS:
            start = 1 if BLANK_FREE.match(plain[1]) else 0
            end = len(plain) - 1 if BLANK_FREE.match(plain[-2]) else len(plain)
            out[plain[start:end]].append(item)
    return dict(out)


def _verbatim(texts: DataFrame, patterns: dict[str, list], schema: str, types: list[pa.DataType]) -> DataFrame:
    """Hits of the items that ``patterns`` names, in ``(doc_id, text)`` rows: the first place of each."""
    sent = texts.sparkSession.sparkContext.broadcast(patterns)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for pattern in sent.value:
            automaton.add_word(pattern, pattern)
        automaton.make_automaton()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                plain = _plain(text.as_py() or "")
                first: dict[str, int] = {}
                for end, pattern in automaton.iter(plain):
                    first.setdefault(pattern, end + 1 - len(pattern))
                for pattern, at in first.items():
                    word = plain.count(" ", 0, at + 1) - 1
                    out += [(doc_id, item, word, 1.0, 1.0) for item in sent.value[pattern]]
            yield _hit_batch(out, types)

    return texts.mapInArrow(run, schema)


def _hit_batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(HIT)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=list(HIT))


def _damped(codes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Weight of each word: less where the same word came shortly before."""
    order = np.argsort(codes, kind="stable")
    again = (codes[order][1:] == codes[order][:-1]) & (np.diff(place[order]) <= REPEAT_REACH)
    weight = np.ones(len(codes), np.float32)
    weight[order[1:][again]] = REPEAT_WEIGHT
    return weight


def _project(codes: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """Latent vectors of length one."""
    rows = [(table[c & (FEATURES - 1)] * _damped(c, np.arange(len(c)))[:, None]).sum(axis=0) for c in codes]
    v = np.array(rows, np.float32).reshape(len(codes), table.shape[1])
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, places of the words, and starts of the documents in one padded run.

    Every document starts on the grid of all window steps, with ``PAD`` or more
    free places behind it, so its windows don't depend on its neighbours.
    """
    sizes = np.array([len(c) for c in docs])
    room = -(-(sizes + PAD) // GRID) * GRID
    starts = np.concatenate([[0], np.cumsum(room)])
    place = np.concatenate([np.arange(n) + at for n, at in zip(sizes, starts, strict=False)])
    return np.concatenate(docs), place, starts


def _candidates(docs: list[np.ndarray], table: np.ndarray, groups: dict, cosine: float) -> Iterator[tuple[int, int, int, int]]:
    """``(document, start, scale, query)`` of the windows that are near a query."""
    codes, place, starts = _padded(docs)
    sizes = np.array([len(c) for c in docs])
    sums = np.zeros((int(starts[-1]) + 1, table.shape[1]), np.float32)
    sums[place + 1] = table[codes & (FEATURES - 1)] * _damped(codes, place)[:, None]
    np.cumsum(sums, axis=0, out=sums)
    for scale, (queries, vectors) in groups.items():
        step = STEPS[scale]
        # the last window of a document also ends where the document ends
        last = (starts[:-1] + sizes - scale)[(sizes > scale) & ((sizes - scale) % step > 0)]
        at = np.concatenate([np.arange(0, max(int(starts[-1]) - scale, 0) + 1, step), last])
        v = sums[np.minimum(at + scale, int(starts[-1]))] - sums[at]
        size = np.sqrt(np.einsum("ij,ij->i", v, v))
        near = v @ vectors.T >= (cosine * np.where(size > 1e-3, size, np.inf))[:, None]
        for w, q in zip(*np.nonzero(near), strict=True):
            d = int(np.searchsorted(starts, at[w], side="right")) - 1
            yield d, int(at[w] - starts[d]), scale, queries[q]


def verdict(words: np.ndarray, asked: np.ndarray, answer: np.ndarray) -> tuple[float, float]:
    """Shares of the item's and of the answer's words found in order in ``words``."""
    held = words.tolist()
    return lcs(asked.tolist(), held) / len(asked), lcs(answer.tolist(), held) / len(answer)


def search(coded: DataFrame, texts: DataFrame, items: DataFrame, idf: np.ndarray, vectors: np.ndarray, values: np.ndarray, cosine: float, verbatim: float, paraphrase: float, shortest: int) -> DataFrame:
    """Hits of every item in every document; ``coded`` holds the word codes of ``texts``."""
    spark = coded.sparkSession
    table = (idf[:, None] * vectors / np.maximum(values, 1e-9)).astype(np.float32)
    asked = items.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    size = asked.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    n_blocks = max(1, -(-int(size[0]) // BLOCK_ITEMS), -(-int(size[1] or 0) // BLOCK_CHARS))
    id_types = [coded.schema["doc_id"].dataType, items.schema["item_id"].dataType]
    schema = f"doc_id {id_types[0].simpleString()}, item_id {id_types[1].simpleString()}, near_word long, lcs_share double, answer_share double"
    types = [*map(to_arrow_type, id_types), pa.int64(), pa.float64(), pa.float64()]
    hits = spark.createDataFrame([], schema)
    for b in range(n_blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b)
        asking = [(r["item_id"], r["text"]) for r in block.collect()]  # a block of bounded size
        patterns = short_patterns(asking, shortest)
        if patterns:
            hits = hits.unionByName(_verbatim(texts, patterns, schema, types))
        queries = item_queries(asking)
        if not queries:
            continue
        groups = {}
        for scale in sorted({q[1] for q in queries}):
            own = [i for i, q in enumerate(queries) if q[1] == scale]
            groups[scale] = (own, _project([queries[i][2] for i in own], table))
        sent = spark.sparkContext.broadcast((table, queries, groups))

        @giving_back
        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            table, queries, groups = sent.value
            sought = [q[3].tolist() for q in queries]
            longest = max(len(q) for q in sought)
            # the widest stretch that is held against an item
            reach = 2 * SCALES[-1] if longest <= SCALES[-1] else 2 * longest + SCALES[-1]
            run_words = max(RUN_WORDS, 4 * reach)

            def look(docs: list[tuple[object, int, np.ndarray]]) -> list[tuple]:
                best: dict[tuple[int, int], tuple] = {}
                tried = set()
                for d, start, scale, q in _candidates([c for _, _, c in docs], table, groups, cosine):
                    doc_id, at, words = docs[d]
                    item, _, piece, codes, answer, lead = queries[q]
                    rest = len(codes) - lead - len(piece)
                    lo = max(0, start - lead - len(codes) // 2)
                    hi = min(len(words), start + scale + rest + len(codes) // 2)
                    if hi - lo < LEAST_WORDS // 2 or (d, q, lo, hi) in tried:
                        continue
                    tried.add((d, q, lo, hi))
                    # words in common bound the common subsequence
                    held = set(words[lo:hi].tolist())
                    if sum([c in held for c in sought[q]]) < paraphrase * len(codes):
                        continue
                    share, told = verdict(words[lo:hi], codes, answer)
                    if share >= verbatim or (share >= paraphrase and told >= ANSWER):
                        hit = (share, told, -(at + max(0, start - lead)))
                        key = (d, item)
                        if key not in best or hit > best[key][1]:
                            best[key] = (doc_id, hit)
                return [(doc_id, item, -place, share, told) for (_, item), (doc_id, (share, told, place)) in best.items()]

            out: list[tuple] = []
            docs: list[tuple[object, int, np.ndarray]] = []
            held = 0
            for batch in batches:
                for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    words = np.frombuffer(value.as_buffer(), "<u2")
                    # a long document is seen in overlapping runs
                    for at in range(0, max(len(words) - reach, 1), run_words - reach):
                        docs.append((doc_id, at, words[at : at + run_words]))
                        held += len(docs[-1][2])
                        if held >= run_words:
                            out += look(docs)
                            docs, held = [], 0
            if held:
                out += look(docs)
            yield _hit_batch(out, types)

        hits = hits.unionByName(coded.mapInArrow(run, schema))
    share, told, place = F.col("lcs_share"), F.col("answer_share"), F.col("near_word")
    best = F.max(F.struct(share, told, (-place).alias("place"))).alias("best")
    return (
        hits.groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", "best.lcs_share", "best.answer_share", (-F.col("best.place")).alias("near_word"))
    )


def contaminated(docs: DataFrame, items: DataFrame, cosine: float = COSINE, verbatim: float = VERBATIM, paraphrase: float = PARAPHRASE, shortest: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, lcs_share, answer_share, near_word``: the documents that hold a benchmark item
    of ``shortest`` words or more."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    coded = materialize(_coded(texts, kind), "codes")
    seen, passages = passage_frequencies(coded)
    idf = np.log((passages + 1) / (seen + 1.0)) * (seen > 0)
    if not passages:
        item = F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id")
        return coded.select("doc_id", item, *[F.lit(0.0).alias(n) for n in ("lcs_share", "answer_share")], F.lit(0).cast("long").alias("near_word")).where("false")
    vectors, values = leading_vectors(coded, idf)
    return search(coded, texts, items, idf, vectors, values, cosine, verbatim, paraphrase, shortest)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", shortest: int = SHORTEST_CUT, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item of ``shortest`` words or more.

    Items of one or two words are plain words and names that clean texts hold too;
    ``shortest=1`` removes those texts as well.

    Rows are told by a hash of their text, so repeated ids with different
    texts are judged apart.
    """
    key = free_name(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{text_col}`")))
    texts = keyed.select(F.col(key).alias("text_key"), F.col(f"`{text_col}`").alias("text"))
    hits = materialize(contaminated(texts, items, id_col="text_key", shortest=shortest, **options).select(F.col("doc_id").alias(key)).distinct(), "hits")
    return keyed.join(hits, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
