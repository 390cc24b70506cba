import collections
import re

from pyspark.sql import functions as F

from avionyx.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    ws = WORD.findall(text or "")
    windows = collections.Counter(zip(ws, ws[1:], ws[2:]))
    hit = set()
    for i, w in enumerate(zip(ws, ws[1:], ws[2:])):
        if windows[w] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup, lines = set(), 0, 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit), lines)


TEXTS = [
    None, "", " \n\t ", "a", "a b c a b c", "x x x x x", "one two\none two\n\none two",
    "é" * 5 + " z w", "# * $ | <a> & %", "w " * 5000, " ".join(f"w{i}" for i in range(60)),
    "a b c\x0bd\x0ca b c", "a b", "a b c d e a b c d e f",
]


def test_measures_match_brute_force(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(TEXTS)] + [(None, "a b c", "x", 1), (3, "a", "clash", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ledger string, fail_bits int")
    out = quality.quality_ledger(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        assert tuple(r["ledger_"][m] for m in quality.MEASURES) == brute(r["text"])
    assert quality.quality_filter(docs).columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality.quality_ledger(docs).count() == 0


def test_ablation_is_bit_arithmetic(spark):
    masks = [0, 1, 1, 2, 3, 4, 6, 32]
    got = {r["rule"]: r for r in quality.ablation(spark.createDataFrame([(m,) for m in masks], "fail_bits long"), "v1").collect()}
    assert set(got) == set(quality.POLICIES["v1"])
    for rule, r in got.items():
        bit, mask = quality.rule_bit(rule), quality.policy_mask("v1")
        assert r["failed"] == sum(bool(m & bit) for m in masks)
        assert r["only"] == sum(m & mask == bit for m in masks)
        assert r["kept_without"] == sum(m & (mask & ~bit) == 0 for m in masks)
    assert spark.range(1).select(quality.passes(F.lit(32).cast("long"), "v1")).first()[0]
