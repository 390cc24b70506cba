"""Language identification by known words first, shorter n-grams after (operator 9).

The model has, per language, the log frequency of words and of character n-grams
of words (padded with ``^`` and ``$``).  A word that the model knows is scored by
its own frequencies; an unseen word by those of its known n-grams of the longest
length that has any, from ``LONGEST`` characters down to one.  The language with
the largest sum over all words of the whole text wins; equal sums go to the
alphabetically first language.

The model is fitted on at most ``sample_rows`` labelled rows (those with the
smallest hashed ids), so its size is bounded whatever the corpus holds; counts
are made by Spark, and only tokens seen ``least`` times reach the driver.

Defined results: ``und`` with score 0 where a text is null or has no letter, or
where no language was learned.  Repeated rows and null ids are scored like others.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avionyx.llm.text import slices

SAMPLE_ROWS = 8000
LONGEST = 5
LEAST = 3
LEAST_GRAM = 5
CACHE = 150_000
UND = "und"

TOKEN = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def has_letter(words) -> bool:
    return any(c.isalpha() for w in words for c in w)


def grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def token_counts(rows: DataFrame) -> DataFrame:
    """``size, token, lang, n``: words (size 0) and n-grams (size n) of the rows ``lang, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts, 500_000):
                words: Counter = Counter()
                for lang, text in zip(langs[lo:hi], texts[lo:hi], strict=True):
                    for w, n in Counter(words_of(text)).items():
                        words[lang, w] += n
                out: Counter = Counter()
                for (lang, w), n in words.items():
                    out[0, w, lang] += n
                    for size in range(1, LONGEST + 1):
                        for g in grams(w, size):
                            out[size, g, lang] += n
                keys = list(zip(*out, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[0], pa.int32()), pa.array(keys[1], pa.string()), pa.array(keys[2], pa.string()), pa.array(list(out.values()), pa.int64())],
                    names=["size", "token", "lang", "n"],
                )

    counted = rows.select("lang", "text").mapInArrow(run, "size int, token string, lang string, n long")
    return counted.groupBy("size", "token", "lang").agg(F.sum("n").alias("n"))


class Model:
    """Per-language log frequencies of words and n-grams.

    ``tables`` maps each size to ``{token: row}``; rows of words come first in
    ``known``, those of unseen words are kept in a cache of bounded size.
    """

    def __init__(self, langs: list[str], tables: dict[int, dict[str, np.ndarray]]):
        self.langs, self.tables = langs, tables
        words = tables.get(0, {})
        self.at = {w: i for i, w in enumerate(words)}
        self.n_words = len(self.at)
        self.rows = np.zeros((self.n_words + CACHE, len(langs)))
        if words:
            self.rows[: self.n_words] = np.array(list(words.values()))
        self.unseen: dict[str, int] = {}

    def backoff(self, w: str) -> np.ndarray:
        """Mean of the known n-grams of the longest length that has any."""
        padded = f"^{w}$"
        for size in range(LONGEST, 0, -1):
            get = self.tables[size].get
            hit = [v for v in [get(padded[i : i + size]) for i in range(len(padded) - size + 1)] if v is not None]
            if hit:
                return np.add.reduce(hit) / len(hit)
        return np.zeros(len(self.langs))

    def word(self, w: str) -> np.ndarray:
        return self.rows[self._row(w)]

    def _row(self, w: str) -> int:
        found = self.at.get(w)
        if found is None:
            found = self.unseen.get(w)
            if found is None:
                found = self.n_words + len(self.unseen)
                self.rows[found] = self.backoff(w)
                self.unseen[w] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text))
        if not self.langs or not has_letter(counts):
            return UND, 0.0
        total = np.zeros(len(self.langs))
        words, times = list(counts), list(counts.values())
        for lo in range(0, len(words), CACHE):
            part = words[lo : lo + CACHE]
            if len(self.unseen) + len(part) > CACHE:
                self.unseen.clear()
            rows = list(map(self.at.get, part))
            if None in rows:
                rows = [self._row(w) if r is None else r for w, r in zip(part, rows, strict=True)]
            total += np.array(times[lo : lo + CACHE], float) @ self.rows[rows]
        best = int(np.argmax(np.round(total, 6)))
        # the posterior of a text of at most 20 words: long texts would always give 1
        tempered = (total - total[best]) * min(1.0, 20 / sum(times))
        return self.langs[best], float(1 / np.exp(np.minimum(tempered, 0)).sum())


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, least: int = LEAST) -> Model:
    """Fit on the rows ``doc_id, text, lang`` (none null but the text) of at most ``sample_rows`` ids."""
    named = rows.where("lang is not null and doc_id is not null")
    # ids first: only narrow rows are sorted, and at most sample_rows of them are sent out
    chosen = named.select("doc_id", F.xxhash64("doc_id").alias("h")).distinct().orderBy("h", "doc_id").limit(sample_rows)
    counts = token_counts(named.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi"))
    often = counts.where((F.col("n") >= F.when(F.col("size") == 0, least).otherwise(LEAST_GRAM)) | (F.col("size") == 1))
    got = [(r["size"], r["token"], r["lang"], r["n"]) for r in often.toLocalIterator()]
    langs = sorted({r[2] for r in got})
    at = {lang: i for i, lang in enumerate(langs)}
    counted: dict[int, dict[str, np.ndarray]] = {size: {} for size in range(LONGEST + 1)}
    for size, token, lang, n in got:
        table = counted[size]
        if token not in table:
            table[token] = np.zeros(len(langs), np.float32)
        table[token][at[lang]] += n
    for table in counted.values():
        if table:
            total = np.sum(list(table.values()), axis=0)
            for token, c in table.items():
                table[token] = np.log((c + 0.5) / (total + 0.5 * len(table))).astype(np.float32)
    return Model(langs, counted)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text."""
    # tokens and one matrix per size: small to send, whatever the number of tokens
    packed = {n: (list(t), np.array(list(t.values()), np.float32)) for n, t in model.tables.items()}
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, packed))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, packed = sent.value
        m = Model(langs, {n: dict(zip(tokens, rows, strict=True)) for n, (tokens, rows) in packed.items()})
        for batch in batches:
            texts = batch.column(1).to_pylist()
            made = [m.predict(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a for a, _ in made], pa.string()), pa.array([b for _, b in made], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
