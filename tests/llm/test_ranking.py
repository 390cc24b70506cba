import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from avionyx.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k):
    docs = [(d, terms(t)) for d, t in rows]
    docs = [(d, ts, Counter(ts)) for d, ts in docs if ts]
    n_docs, total = len(docs), sum(len(ts) for _, ts, _ in docs)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        w = {}
        for t in asked:
            df = sum(t in c for _, _, c in docs)
            w[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        scored = []
        for d, ts, c in docs:
            m = 25 + 75 * len(ts) * n_docs // total
            score = sum(q * w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in asked.items() if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def ranked(spark, rows, items, k=10):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, terms string, n int")
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, score int")
    got = ranking.rank_documents(docs.repartition(3), asked, k).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=repr)


def corpus(rng, n):
    words = [f"w{i}" for i in range(80)] + ["É", "ß1", "A-b", "x_y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randrange(0, 60)))) for i in range(n)]


@pytest.mark.parametrize(("segment", "step"), [(2_000_000, 16), (300, 1), (50, 4)])
def test_ranks_equal_brute_force(spark, monkeypatch, segment, step):
    monkeypatch.setattr(ranking, "SEGMENT_POSTINGS", segment)
    monkeypatch.setattr(ranking, "FIRST_STEP", step)
    monkeypatch.setattr(ranking, "DIRECT_ACCESSES", 64)
    rng = random.Random(segment)
    rows = corpus(rng, 300)
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # ties
    items = [(i, " ".join(rng.choices([t for _, t in rows][:50], k=1)[0].split()[:20])) for i in range(12)]
    assert ranked(spark, rows, items) == brute(rows, items, 10)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "--- ..."), (None, "Alpha beta"), (None, "alpha BETA"), (4, "alpha beta"), (4, "alpha beta"), (5, "gamma " * 30_000), (6, "ÀÉ\x00x\x7fy"), (7, "gamma")]
    items = [(1, "alpha"), (1, "alpha"), (2, None), (3, "nowhere at all"), (None, "GAMMA gamma"), (5, "ÀÉ x"), (6, "àé")]
    assert ranked(spark, rows, items, 4) == brute(rows, items, 4)
    assert ranked(spark, rows[:3], items) == [] and ranked(spark, [], items) == [] and ranked(spark, rows, []) == []


def test_queries_in_blocks(spark, monkeypatch):
    rng = random.Random(9)
    rows = corpus(rng, 120)
    items = [(i, " ".join(rng.choices(["w1", "w5", "w30", "w70", "ß1"], k=4))) for i in range(9)]
    monkeypatch.setattr(ranking, "BLOCK_ITEMS", 4)
    assert ranked(spark, rows, items, 3) == brute(rows, items, 3)


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one two"), ("c", "two")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "one")], "item_id string, text string")
    assert [tuple(r)[:3] for r in ranking.rank_documents(docs, items, 3).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]


def test_reading_stops_before_the_lists_end():
    """With a few documents far above the rest, best positions end the search early."""
    rng = np.random.default_rng(3)
    n = 20_000
    counts = rng.integers(1, 4, size=(n, 3))
    counts[:12] = 500
    ends = np.arange(0, 3 * n + 1, 3)
    segment = ranking.Segment([200] * n, ends, np.tile(np.arange(3), n), counts.ravel(), 3, n, 200 * n)
    got = []

    def offer(docs, scores):
        got.extend(zip(scores.tolist(), docs.tolist(), strict=True))
        return sorted(got, reverse=True)[9][0] if len(got) >= 10 else 0

    read = segment.best(np.arange(3), np.array([5, 3, 2]), 0, offer)
    assert {d for _, d in sorted(got, reverse=True)[:12]} == set(range(12))
    assert read < 0.01 * 3 * n and not segment.seen.any()
