"""Toxicity by a weighted finite-state pattern grammar (operator 5).

A clause is scored by a cascade of weighted transducers over the max-plus
semiring: weights add along a path and the best path counts.

* The lexicon reads a word and writes its class: insult, threat, target,
  negation, report, frame (a common function word) or other.  An insult or threat
  may also be written as other, at no weight, so reading it as one is a choice
  that only a pattern can pay for.
* The negation transducer passes classes on and takes ``NEGATED`` from an insult or
  threat within four words of a negation; the report transducer takes ``REPORTED``
  from one that follows a verb of saying.
* The insult and threat transducer accepts insults only inside a pattern: near a
  target, in a frame ("a ... clown of"), in a run of insults, as an address at the
  clause's start or end, or alone as the whole clause, and threats only near a target.  Words in between cost ``GAP`` each.

The machines after the lexicon are composed, output tape to input tape, into one.
A clause's weight is that of its best path, so a word out of place adds nothing,
and the order of words matters.  A document is scored by the weights of its
matched clauses through a logistic curve whose coefficients are not negative:
negation and reported speech never raise a score.

Insult stems (word beginnings that hardly occur outside toxic rows), frame words
and the curve are fitted on at most ``sample_rows`` labelled rows, those with the
smallest hashed ids; of repeated ids the largest label and the smallest text
count.  The other classes are the fixed English lists.

Defined results: a null or empty text has no clause and gets the score of the
bias alone.  Repeated rows are scored alike, each by itself.  With no labelled row,
or labels of one kind, the fixed lists and fixed coefficients decide.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from avionyx.llm.text import slices
from avionyx.session import materialize

SAMPLE_ROWS = 12_000
CACHE = 300_000
STEM_LENGTHS = range(3, 9)
LEAST_TOXIC = 3
LEAST_ODDS = 12.0
PARTS = 5
LEAST_WEIGHT = 0.5
# a function word of a language with a tenth of the rows, in a fifth of them
FRAME_SHARE = 0.02

# a colon does not end a clause: it leads to what is said
TOKEN = re.compile(r"\w+|[.,;!?\n]+")
LISTED = "="
BREAKS = frozenset(".,;!?\n")

# The English word classes of the grammar.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting clown clowns "
    "fool fools jerk jerks imbecile cretin vermin filth coward liar freak creep pig swine rat useless"
).split()
THREATS = "kill hurt destroy punch beat burn shoot stab crush hang strangle smash attack ruin".split()
TARGETS = "you your yours he him his she her they them their these those people everyone".split()
NEGATIONS = "not no never nobody none neither nor without isn aren wasn weren don doesn didn cannot can't".split()
REPORTS = "said says say called calls wrote writes claimed claims reported reports quoted alleged told tells according".split()

# Frame words known without any labelled row.
FRAMES = "a an the this that of is are was were be and as such with for to in".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, FRAME = range(7)
SYMBOLS = range(FRAME + 1)
MARKED = (INSULT, THREAT)
WORD_LISTS = ((FRAME, FRAMES), (REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS), (INSULT, INSULTS))
FIXED = {w: s for s, words in WORD_LISTS for w in words}

# Arc weights of the grammar.
FIXED_WEIGHT = 3.0
GAP = -0.3
NEGATED = -6.0
REPORTED = -4.0
AT_TARGET = 1.5
ADDRESS = -1.0

Arc = tuple[int, object, float]


class Transducer:
    """``arcs[state][symbol]`` lists ``(next state, output, weight)``; state 0 is first, ``finals`` may end a clause."""

    def __init__(self) -> None:
        self.arcs: list[dict[object, list[Arc]]] = []
        self.finals: set[int] = set()
        self.names: dict[object, int] = {}

    def state(self, name: object, final: bool = True) -> int:
        if name not in self.names:
            self.names[name] = len(self.arcs)
            self.arcs.append({})
            if final:
                self.finals.add(self.names[name])
        return self.names[name]

    def arc(self, at: int, symbol: object, to: int, output: object, weight: float = 0.0) -> None:
        self.arcs[at].setdefault(symbol, []).append((to, output, weight))

    def __matmul__(self, other: Transducer) -> Transducer:
        """Composition: what this machine writes, the other one reads; weights add."""
        out = Transducer()
        out.state((0, 0), 0 in self.finals and 0 in other.finals)
        todo = [(0, 0)]
        for a, b in todo:
            for symbol, arcs in self.arcs[a].items():
                for to_a, between, w in arcs:
                    for to_b, output, v in other.arcs[b].get(between, ()):
                        pair = (to_a, to_b)
                        if pair not in out.names:
                            todo.append(pair)
                        to = out.state(pair, to_a in self.finals and to_b in other.finals)
                        out.arc(out.names[a, b], symbol, to, output, w + v)
        return out

    def best(self, clause: list[list[tuple[int, float]]]) -> tuple[float, tuple]:
        """Weight and outputs of the best path; ``clause`` lists each word's classes with their weights.

        Equal weights: the path with the smaller outputs.  No accepted path: 0.
        """
        reached: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        for choices in clause:
            ahead: dict[int, tuple[float, tuple]] = {}
            for at, (weight, outputs) in reached.items():
                arcs = self.arcs[at]
                for symbol, lexical in choices:
                    for to, output, w in arcs.get(symbol, ()):
                        total = weight + lexical + w
                        held = ahead.get(to)
                        if held is None or total >= held[0]:
                            made = outputs if output is None else (*outputs, output)
                            if held is None or total > held[0] or made < held[1]:
                                ahead[to] = (total, made)
            reached = ahead
        ends = [reached[q] for q in reached if q in self.finals]
        return min(ends, key=lambda e: (-e[0], e[1])) if ends else (0.0, ())


def scope(opens: int, reach: int | None, weight: float) -> Transducer:
    """Copies classes; insults and threats get ``weight`` within ``reach`` words after ``opens`` (None: to the clause's end)."""
    out = Transducer()
    last = 1 if reach is None else reach
    for left in range(last + 1):
        out.state(left)
    for left in range(last + 1):
        for s in SYMBOLS:
            to = last if s == opens else left if reach is None else max(0, left - 1)
            out.arc(left, s, to, s, weight if left and s in MARKED else 0.0)
    return out


def patterns() -> Transducer:
    """Accepts clauses whose insults and threats all lie in a pattern; writes one event for each."""
    out = Transducer()
    start, idle = out.state("start"), out.state("idle")
    passing = [s for s in SYMBOLS if s not in MARKED]
    for s in passing:
        out.arc(start, s, idle, None)
        out.arc(idle, s, idle, None)

    def before(opens: int, reach: int, hits: dict[int, tuple[str, float]]) -> None:
        """An opening word, then insults or threats at most ``reach`` words on; each stays in its reach."""
        chain = [out.state((opens, "before", k)) for k in range(reach)]
        for at in (start, idle):
            out.arc(at, opens, chain[0], None)
        for k, at in enumerate(chain):
            after = chain[k + 1] if k + 1 < reach else idle
            for s in passing:
                out.arc(at, s, after, None, GAP)
            out.arc(at, opens, chain[0], None)
            for s, (event, weight) in hits.items():
                out.arc(at, s, after, event, weight)

    def after(word: int, closes: int, reach: int, event: str, weight: float) -> None:
        """An insult or threat that waits at most ``reach`` words for the word that completes it."""
        chain = [out.state((word, closes, k), final=False) for k in range(reach)]
        for at in (start, idle):
            out.arc(at, word, chain[0], None)
        for k, at in enumerate(chain):
            out.arc(at, closes, idle, event, weight)
            if k + 1 < reach:
                for s in passing:
                    out.arc(at, s, chain[k + 1], None, GAP)

    before(TARGET, 5, {INSULT: ("insult_target", AT_TARGET), THREAT: ("threat", AT_TARGET)})
    before(FRAME, 3, {INSULT: ("insult_frame", 0.0)})
    after(INSULT, TARGET, 3, "insult_target", AT_TARGET)
    after(INSULT, FRAME, 3, "insult_frame", 0.0)
    after(THREAT, TARGET, 4, "threat", AT_TARGET)
    alone, run, address = out.state("alone"), out.state("run"), out.state("address")
    opened = out.state("run opened", final=False)
    out.arc(start, INSULT, alone, "insult_clause")
    out.arc(alone, INSULT, alone, "insult_clause")
    out.arc(start, INSULT, idle, "insult_address", ADDRESS)
    out.arc(idle, INSULT, address, "insult_address", ADDRESS)
    for at in (start, idle):
        out.arc(at, INSULT, opened, None)
    out.arc(opened, INSULT, run, "insult_run")
    out.arc(run, INSULT, run, "insult_run")
    for s in passing:
        out.arc(run, s, idle, None)
    return out


GRAMMAR = scope(NEGATION, 4, NEGATED) @ scope(REPORT, None, REPORTED) @ patterns()


class Lexicon:
    """The first transducer: the classes of a word with their weights, from the fixed lists, frames and stems."""

    def __init__(self, stems: dict[str, float], frames: frozenset[str] = frozenset()):
        self.stems, self.frames = stems, frames
        self.lengths = sorted({len(s) for s in stems if not s.startswith(LISTED)})
        self.cache: dict[str, list[tuple[int, float]]] = {}

    def choices(self, word: str) -> list[tuple[int, float]]:
        found = self.cache.get(word)
        if found is None:
            found = self.look_up(word)
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found

    def look_up(self, word: str) -> list[tuple[int, float]]:
        symbol = FIXED.get(word)
        if symbol in MARKED:
            return [(OTHER, 0.0), (symbol, self.stems.get(LISTED + word, FIXED_WEIGHT))]
        if symbol is not None:
            return [(symbol, 0.0)]
        if word in self.frames:
            return [(FRAME, 0.0)]
        for n in self.lengths:
            weight = self.stems.get(word[:n]) if len(word) >= n else None
            if weight is not None:
                return [(OTHER, 0.0), (INSULT, weight)]
        return [(OTHER, 0.0)]


def matched(text: str | None, lexicon: Lexicon) -> Iterator[tuple[int, int, float, tuple]]:
    """``(start, end, weight, events)`` of every clause with a matched pattern, places in code points of the text."""
    if not text:
        return
    clause: list[list[tuple[int, float]]] = []
    begin, end, marked = 0, 0, False
    for token in TOKEN.finditer(text):
        word = token.group()
        if word[0] in BREAKS:
            if marked:
                weight, events = GRAMMAR.best(clause)
                if events and weight > 0:
                    yield begin, end, weight, events
            clause, marked = [], False
            continue
        choices = lexicon.choices(word.lower())
        if not clause:
            begin = token.start()
        end = token.end()
        marked = marked or len(choices) > 1
        clause.append(choices)
    if marked:
        weight, events = GRAMMAR.best(clause)
        if events and weight > 0:
            yield begin, end, weight, events


def features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """Logs of the matched clauses' summed weight and of the number of their events."""
    total, events = 0.0, 0
    for _, _, weight, found in matched(text, lexicon):
        total += weight
        events += len(found)
    return np.log1p([total, events])


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray, bias: float):
        self.lexicon, self.weights, self.bias = lexicon, weights, bias

    def score(self, text: str | None) -> float:
        z = float(features(text, self.lexicon) @ self.weights + self.bias)
        return 1 / (1 + float(np.exp(-max(-30.0, min(30.0, z)))))


def beginnings(rows: DataFrame) -> DataFrame:
    """``stem, toxic_0, clean_0, toxic_1, ...``: in how many toxic and clean rows of each part a word beginning occurs.

    Listed insults and threats are counted whole, marked by ``LISTED``.
    """
    counts = [f"{kind}_{part}" for part in range(PARTS) for kind in ("toxic", "clean")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, parts, texts = (batch.column(i).to_pylist() for i in range(3))
            for lo, hi in slices(texts, 1_000_000):
                seen = {c: Counter() for c in counts}
                for label, part, text in zip(labels[lo:hi], parts[lo:hi], texts[lo:hi], strict=True):
                    words = {w for w in TOKEN.findall(text.lower()) if w[0].isalpha()} if text else ()
                    found = seen[f"{'toxic' if label else 'clean'}_{part}"]
                    found.update({w[:n] for w in words if w not in FIXED for n in STEM_LENGTHS if len(w) >= n})
                    found.update(LISTED + w for w in words if FIXED.get(w) in MARKED)
                stems = list(set().union(*seen.values()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(stems, pa.string()), *[pa.array([seen[c][s] for s in stems], pa.int64()) for c in counts]],
                    names=["stem", *counts],
                )

    counted = rows.select("toxic", "part", "text").mapInArrow(run, "stem string, " + ", ".join(f"{c} long" for c in counts))
    return counted.groupBy("stem").agg(*[F.sum(c).alias(c) for c in counts])


def choose_stems(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """The shortest beginnings that mark toxic rows, and all listed words, with their smoothed log odds."""
    out: dict[str, float] = {}
    for stem, toxic, clean in sorted(counts, key=lambda r: (len(r[0]), r[0])):
        if any(stem[:n] in out for n in range(1, len(stem))):
            continue
        odds = ((toxic + 0.5) / (n_toxic + 1)) / ((clean + 0.5) / (n_clean + 1))
        if stem.startswith(LISTED):
            out[stem] = max(LEAST_WEIGHT, float(np.log(odds)))
        elif toxic >= max(LEAST_TOXIC, 0.003 * n_toxic) and odds >= LEAST_ODDS and toxic > 4 * clean:
            out[stem] = float(np.log(odds))
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; the bias is not shrunk."""
    z = np.hstack([x, np.ones((len(x), 1))])
    beta, shrink = np.zeros(z.shape[1]), np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (y - p) - shrink * beta
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(shrink), slope)
        beta = beta + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def rising_logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression without negative coefficients: the most negative feature leaves until none is."""
    weights, keep = np.zeros(x.shape[1]), list(range(x.shape[1]))
    while True:
        fitted, bias = logistic(x[:, keep], y)
        if not keep or fitted.min() >= 0:
            weights[keep] = fitted
            return weights, bias
        keep.pop(int(fitted.argmin()))


def frame_words(rows: DataFrame, size: int) -> DataFrame:
    """``word``: words in at least ``FRAME_SHARE`` of the ``size`` rows, so at most 1 / FRAME_SHARE times the mean row's."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("(?U)\\w+"), F.lit(0)))
    found = rows.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return found.where(F.col("n") >= FRAME_SHARE * size).select("word")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` rows of ``labels`` (``doc_id, toxic``) with the texts of ``docs``."""
    sample = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # the sample holds at most sample_rows narrow rows
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("part")), F.lit(PARTS)).cast("int")
    rows = materialize(rows.select("toxic", part.alias("part"), "text"), "toxic-sample")
    sizes = Counter({(r["part"], r["toxic"]): r["n"] for r in rows.groupBy("part", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()})
    n_toxic, n_clean = (sum(sizes[p, label] for p in range(PARTS)) for label in (1, 0))
    if not n_toxic or not n_clean:
        return Model(Lexicon({}), np.array([2.0, 0.5]), -3.0)
    toxic, clean = (reduce(add, [F.col(f"{kind}_{p}") for p in range(PARTS)]) for kind in ("toxic", "clean"))
    marks = toxic > 4 * clean
    for p in range(PARTS):
        marks |= toxic - F.col(f"toxic_{p}") > 4 * (clean - F.col(f"clean_{p}"))
    counted = beginnings(rows).withColumns({"toxic": toxic, "clean": clean})
    counts = counted.where(((F.col("toxic") >= LEAST_TOXIC) & marks) | F.col("stem").startswith(LISTED)).collect()
    stems = choose_stems([(r["stem"], r["toxic"], r["clean"]) for r in counts], n_toxic, n_clean)
    # the curve is fitted on hits of stems chosen from the other parts, so chance stems earn no trust
    other = {
        p: choose_stems(
            [(r["stem"], r["toxic"] - r[f"toxic_{p}"], r["clean"] - r[f"clean_{p}"]) for r in counts],
            n_toxic - sizes[p, 1],
            n_clean - sizes[p, 0],
        )
        for p in range(PARTS)
    }
    frames = frozenset(r["word"] for r in frame_words(rows, n_toxic + n_clean).collect())
    sent = docs.sparkSession.sparkContext.broadcast((other, frames))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, common = sent.value
        lexicons = {p: Lexicon(chosen[p], common) for p in chosen}
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            made = [features(t, lexicons[p]).tolist() for p, t in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.float64()))], names=["toxic", "x"])

    got = rows.mapInArrow(run, "toxic int, x array<double>").collect()  # at most sample_rows short rows
    x, y = np.array([r["x"] for r in got]), np.array([r["toxic"] for r in got], float)
    weights, bias = rising_logistic(x, y)
    return Model(Lexicon(stems, frames), weights, bias)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast((model.lexicon.stems, model.lexicon.frames, model.weights, model.bias))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stems, frames, weights, bias = sent.value
        m = Model(Lexicon(stems, frames), weights, bias)
        for batch in batches:
            scores = [m.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def matched_clauses(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, end, weight, events, clause``: what the score of each document rests on."""
    sent = docs.sparkSession.sparkContext.broadcast((model.lexicon.stems, model.lexicon.frames))
    kind = docs.schema[id_col].dataType.simpleString()
    ids = to_arrow_type(docs.schema[id_col].dataType)
    types = [ids, pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.string()), pa.string()]
    names = ["doc_id", "start", "end", "weight", "events", "clause"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(*sent.value)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = [(doc, a, b, w, list(e), text[a:b]) for a, b, w, e in matched(text, lexicon)]
                if found:
                    columns = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, start long, end long, weight double, events array<string>, clause string")
