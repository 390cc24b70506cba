"""Quality rules as a bitmask ledger (operator 10).

Every rule is evaluated once per document.  The ledger keeps the
measurements and one bit per failed rule; a policy is a version name with the
mask of the rules it applies, so a new policy or an ablation is bit
arithmetic over the stored ledger and never reads a text again.

Defined results: a null or empty text has no words, all measurements are 0
and the base rule ``few_words`` fails.  A null ``doc_id`` and repeated rows
pass through unchanged, one ledger per row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from avionyx.llm.text import WORD, append_column, free_name

SYMBOLS = "#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

LEDGER = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])

# Rule name -> SQL condition that is true when the rule FAILS.
# The position is the bit.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 80 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}

BASE_RULES = ("few_words", "repeated_words")

# Policy version -> the rules it applies.
POLICIES = {
    "base": BASE_RULES,
    "v1": (*BASE_RULES, "symbols"),
    "v2": tuple(RULES),
}

CURRENT = "v2"


def rule_bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def policy_mask(policy: str) -> int:
    return sum(rule_bit(r) for r in POLICIES[policy])


def _repeat_words(words: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document, the words inside a three-word window that occurs twice or more."""
    if len(words) < 3:
        return np.zeros(n_docs, np.int64)
    code = pd.factorize(words)[0].astype(np.int64)
    size = int(code.max()) + 1
    inside = doc[2:] == doc[:-2]
    pair = pd.factorize(code[:-2] * size + code[1:-1])[0].astype(np.int64)
    triple = pd.factorize(pair * size + code[2:])[0].astype(np.int64)
    window = pd.factorize(doc[:-2] * (int(triple.max()) + 1) + triple)[0]
    often = np.bincount(window[inside], minlength=int(window.max()) + 1) > 1
    hit = inside & often[window]
    marked = np.zeros(len(words), bool)
    for shift in range(3):
        marked[shift : len(words) - 2 + shift] |= hit
    return np.bincount(doc[marked], minlength=n_docs)


def measure_texts(texts: list[str | None]) -> list[dict]:
    """The measurements of each text, computed over one slice of texts."""
    found = [WORD.findall(t) if t else [] for t in texts]
    counts = np.array([len(w) for w in found], np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    words = np.array([w for ws in found for w in ws], dtype=object)
    repeats = _repeat_words(words, doc, len(texts))
    out = []
    for text, ws, rep in zip(texts, found, repeats.tolist(), strict=True):
        lines = [x for x in text.split("\n") if WORD.search(x)] if text else []
        out.append(
            {
                "n_words": len(ws),
                "word_chars": sum(map(len, ws)),
                "n_symbols": sum(text.count(c) for c in SYMBOLS) if text else 0,
                "n_dup_lines": len(lines) - len(set(lines)),
                "n_repeat_words": rep,
                "n_lines": len(lines),
            }
        )
    return out


def fail_bits(ledger: str) -> Column:
    """The bitmask of failed rules, from the measurements in the struct column ``ledger``."""
    bits = F.lit(0).cast("long")
    for rule, condition in RULES.items():
        names = sorted(MEASURES, key=len, reverse=True)
        text = " ".join(f"`{ledger}`.{w}" if w in names else w for w in condition.split())
        bits = bits.bitwiseOR(F.when(F.expr(text), F.lit(rule_bit(rule))).otherwise(F.lit(0)).cast("long"))
    return bits


def quality_ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns: the struct ``ledger`` and the long ``fail_bits``
    (underscores are appended to a name that ``docs`` already has)."""
    ledger, bits = free_name(docs, "ledger"), free_name(docs, "fail_bits")
    measured = append_column(docs, text_col, ledger, LEDGER, measure_texts)
    return measured.withColumn(bits, fail_bits(ledger))


def passes(bits: Column, policy: str = CURRENT) -> Column:
    """True where no rule of ``policy`` failed."""
    return bits.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0


def quality_filter(docs: DataFrame, policy: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass ``policy``, with the columns of ``docs``."""
    ledger = quality_ledger(docs, text_col)
    return ledger.where(passes(F.col(ledger.columns[-1]), policy)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def ablation(bits: DataFrame, policy: str = CURRENT) -> DataFrame:
    """What each rule of ``policy`` does, from the stored bits alone.

    One row per rule: ``failed`` rows, rows that ``only`` this rule rejects
    (they would come back without it), and ``kept_without``, the rows kept by
    the policy less this rule.  ``bits`` has the long column ``fail_bits``;
    rows are first counted per distinct mask, at most 2 ** rules of them.
    """
    masks = bits.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    mask = policy_mask(policy)
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(rule_bit(r)).cast("long").alias("bit")) for r in POLICIES[policy]])
    each = masks.select("fail_bits", "n", F.explode(rules).alias("r")).select("fail_bits", "n", "r.*")
    hit = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
    n_if = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy("rule", "bit").agg(
        n_if(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        n_if(hit == F.col("bit")).alias("only"),
        n_if(hit.bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
    )
