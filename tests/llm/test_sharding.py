import collections
import random
import zlib

from pyspark.sql import functions as F

from avionyx.llm import sharding
from avionyx.llm.queries import op8_sharding


def brute(units, shards):
    loads = [0] * shards
    out = {}
    for unit, size in sorted(units, key=lambda u: (-u[1], u[0])):
        s = min(range(shards), key=lambda i: (loads[i], i))
        out[unit] = s
        loads[s] += size
    return out


def test_classes_are_dealt_as_the_greedy_rule_deals_groups():
    rng = random.Random(0)
    for _ in range(100):
        sizes = [rng.choice([1, 7, rng.randrange(1, 50), 4000]) for _ in range(rng.randrange(0, 90))]
        classes = collections.Counter(sizes)
        want = brute(list(enumerate(sizes)), 7)
        dealt = sharding.longest_first([(size, n, n * size) for size, n in classes.items()], 7)
        for size, taken in dealt.items():
            assert taken == [sum(s == shard and sizes[i] == size for i, s in want.items()) for shard in range(7)]


def test_size_classes(spark):
    sizes = [1, 2, 2047, 2048, 2049, 2050, 5001, 10**6 + 1, 2**62 + 5]
    out = spark.createDataFrame([(s,) for s in sizes], "s long").select("s", sharding.size_class(F.col("s")).alias("c")).collect()
    for s, c in out:
        drop = max(0, s.bit_length() - sharding.SIGNIFICANT)
        assert c == (s >> drop) << drop


def check(rows, out, shards):
    assert len(out) == len(rows)
    texts = collections.defaultdict(list)
    for d, t in rows:
        texts[d].append(t)
    slots, loads, where = collections.defaultdict(list), [0] * shards, collections.defaultdict(set)
    for r in out:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        if len(set(texts[r["doc_id"]])) == 1:
            t = texts[r["doc_id"]][0]
            raw = (t or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
            where[t].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads


def test_edge_rows(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["same text", "x" * rng.randrange(400), "é" * 9])) for i in range(500)]
    rows += [(None, "same text"), (None, None), (5, None), (6, ""), (5, "more"), (700, "L" * 30_000)] + [(7, rows[7][1])] * 3
    docs = spark.createDataFrame([(*r, 1, "g") for r in rows], "doc_id long, text string, size int, `group` string")
    check(rows, sharding.assign_shards(docs, 4).collect(), 4)
    assert sharding.assign_shards(docs.limit(0), 4).count() == 0


def test_one_row_many_times_and_a_hot_text(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 50)
    monkeypatch.setattr(sharding, "LOT", 7)
    rows = [(1, "the same row")] * 300 + [(i, "one text") for i in range(300)] + [(i, f"text {i}") for i in range(1000, 1300)]
    check(rows, sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect(), 5)


def test_many_small_groups_are_placed_by_size(spark):
    """256,410 groups of sizes far apart: the shards end up within the smallest size of one another."""
    docs = spark.range(256_410).selectExpr("id as doc_id", "concat(id, repeat('x', int(id * 7919 % 601)))as text")
    loads = [r["b"] for r in sharding.assign_shards(docs, 16).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(loads) == 16 and max(loads) - min(loads) <= 16


def test_slots_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 20)
    rows = [(i, f"text {i % 90}") for i in range(400)]
    check(rows, sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect(), 3)


def test_documents_are_balanced(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    loads = check(rows, op8_sharding(spark, sf).collect(), 16)
    assert max(loads) <= 1.01 * min(loads)
