import collections
import hashlib
import math
import random
import re

import pytest

from avionyx.llm import mixing
from avionyx.llm.queries import op12_weighted_mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, weights, most, total):
    """Targets by repeated resharing of what the capped sources leave."""
    goal = {s: 0.0 for s in sizes}
    free, left = set(sizes), float(total)
    while free and left > 1e-9:
        whole = sum(weights[s] for s in free)
        if not whole:
            break
        add = {s: left * weights[s] / whole for s in free}
        left = 0.0
        for s, x in add.items():
            goal[s] += x
            if goal[s] >= most * sizes[s] - 1e-9:
                left += goal[s] - most * sizes[s]
                goal[s] = float(most * sizes[s])
                free.discard(s)
    return goal


def expected(rows, most=3, seed=12):
    """Documents (id, text, source) in key order take whole epochs, then the rest."""
    size = lambda t: len(WORD.findall(t or ""))
    order = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    goals = fill({s: sizes[s] for s in order}, weights, most, sum(sizes.values()))
    out = []
    for s in order:
        docs = []
        for d, t, source in rows:
            if source == s:
                digest = hashlib.md5("|".join([str(d if d is not None else ""), s or "", hashlib.md5((t or "").encode()).hexdigest(), str(seed)]).encode()).hexdigest()
                u = (int(digest[:13], 16) + 0.5) / 2**52
                ink = [c for c in t or "" if c not in mixing.BLANKS]
                q = max(0.05, sum(c not in mixing.NOISE for c in ink) / len(ink)) if ink else 0.05
                docs.append((-math.log(u) / q, d is not None, d or 0, size(t), d))
        goal = math.floor(goals[s] + 0.5)
        epochs, rest = divmod(goal, sizes[s]) if sizes[s] else (0, 0)
        for _, _, _, n, d in sorted(docs):
            extra = min(n, rest)
            rest -= extra
            out.append((d, n, sizes[s], round(goals[s], 6), epochs * n + extra))
    return sorted(out, key=repr)


def taken(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows], "doc_id long, text string, source string, size int, part int, key double")


@pytest.mark.parametrize("per_range", [1_000_000, 15])
def test_mix_equals_brute_force(spark, monkeypatch, per_range):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", per_range)
    rng = random.Random(4)
    text = lambda: " ".join(rng.choice(["word", "12", "é", "a#b"]) for _ in range(rng.randrange(0, 60)))
    rows = [(i, text(), rng.choice(["hot"] * 6 + ["b", "ä", "c", "tiny"])) for i in range(400)]
    rows += [(None, text(), None), (None, None, None), (3, "", "empty"), (900, "w " * 20_000, "b"), (901, "one\x0btwo\x85three", "c")]
    rows += [(77, "the same row again", "hot")] * 40
    assert taken(mixing.mix(frame(spark, rows))) == expected(rows)


def test_no_rows_and_no_words(spark):
    assert mixing.mix(frame(spark, [(1, "a", "s")]).limit(0)).collect() == []
    assert taken(mixing.mix(frame(spark, [(1, None, "s"), (2, "", None)]))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_weights_by_name_and_budget(spark):
    rows = [(i, "w " * 10, "a" if i % 2 else "b") for i in range(100)]
    weights = spark.createDataFrame([("a", 3), ("b", 1)], "source string, weight int")
    got = mixing.mix(frame(spark, rows), weights, budget=800).collect()
    words = collections.Counter()
    for r in got:
        words[r["source"]] += r["taken"]
    assert words == {"a": 600, "b": 200}
    # every document of a is taken once before any is taken twice
    assert {r["taken"] for r in got if r["source"] == "a"} == {10, 20}


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, "clean words only here" if i % 2 else "12 ## 34 $$ word", "a") for i in range(4000)]
    got = mixing.mix(frame(spark, rows), budget=4000).collect()
    share = collections.Counter()
    for r in got:
        share[r["doc_id"] % 2] += r["taken"] > 0
    assert share[1] > 2 * share[0]


def test_query_meets_targets(spark):
    got = op12_weighted_mix(spark, "/root/testdata/sf0.01")
    again = sorted(map(tuple, got.collect()))
    assert again == sorted(map(tuple, op12_weighted_mix(spark, "/root/testdata/sf0.01").collect()))
    words, goal = collections.Counter(), {}
    for r in again:
        words[r[5]] += r[4]
        goal[r[5]] = r[3]
        assert r[4] <= 3 * r[1]
    assert all(abs(words[s] - goal[s]) <= 0.5 for s in goal)
