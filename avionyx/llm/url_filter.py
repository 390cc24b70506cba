"""URL filter: host word segmentation and naive Bayes (operator 7).

1. Explicit rules ``(host, path)`` decide first: a rule fits its host and all
   subdomains if the url's path starts with the rule's path; the longest wins.
2. Every other url goes to the method.  The labels of its host are cut into words
   by a unigram Viterbi search: the cut with the largest product of word
   probabilities, where words and counts come from the text of all pages (and a
   fixed list of unwanted words, which hosts hold but clean pages rarely do),
   scaled to a fixed total; words mentioned too rarely are unknown; a run of characters that is no word costs more the longer it is.
3. Multinomial naive Bayes scores the tokens (host words, path tokens).  It is
   trained on all urls: a url whose cut host holds an unwanted word is a positive
   example, any other a negative one; with the counts of every token in both
   classes it also blocks hosts that share the other tokens of bad hosts.

Word counts are never broadcast: the substrings of the distinct host labels are
joined with the counted words, and each label is cut on its own row.

Defined results: a null url, or one without ``://``, has an empty host and path
and is allowed; a host and path without a letter or digit have the prior odds; repeated
rows are judged alike; a null html adds no words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avionyx.session import materialize

# Words that mark unwanted hosts.
UNWANTED = (
    "adult ads adserver bet bets betting bingo casino cheap cialis dating escort farm free gambling gratis jackpot "
    "lottery nude pharma pharmacy pills poker porn sex slots spam tracker track viagra warez win xxx"
).split()
SURE = ("adult", "ads", "bets", "betting", "casino", "cialis", "escort", "gambling", "pills", "poker", "porn", "sex", "spam", "viagra", "warez", "xxx")

# Verdict by rule: (host, path, verdict), given by the policy in use.
Rule = tuple[str, str, str]

LONGEST_WORD = 24
LONGEST_LABEL = 63
# Probability of an unwanted word besides its mentions, the total that counts are
# scaled to, and the mentions (also as a share of all) below which a word of the
# pages is unknown: a host's own joined name, printed here and there, is no word.
UNWANTED_SHARE = 1e-5
TOTAL = 10**8
LEAST_COUNT, LEAST_SHARE = 5, 1e-7
PRIOR = 1.0

WORD = re.compile(r"[^\W_]+")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_name(rule: Rule) -> str:
    return rule[0] + rule[1]


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(rule_name(r)), rule_name(r))):
        fits = ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])
        out = F.when(fits, F.lit(rule_name(rule))).otherwise(out)
    return out


def page_words(pages: DataFrame) -> DataFrame:
    """``word, n``: how often each short word occurs in the text of all pages (tags removed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag = re.compile(r"(?s)<(script|style)\b.*?</\1\s*>|<[^>]*>")
        for batch in batches:
            counts: dict[str, int] = {}
            for html in batch.column(0).to_pylist():
                for w in WORD.findall(tag.sub(" ", html).lower()) if html else ():
                    if len(w) <= LONGEST_WORD:
                        counts[w] = counts.get(w, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return pages.select("html").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def cut(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words of ``label`` (unigram Viterbi).

    An unknown run of length n has the probability 10 / (total * 10 ** n), so
    known words win where they fit; equal scores prefer the longer last word.
    """
    best: list[tuple[float, int]] = [(0.0, 0)]
    scale = math.log(max(total, 10))
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - LONGEST_WORD), end):
            n = counts.get(label[start:end], 0)
            value = math.log(n) - scale if n > 0 else (1 - (end - start)) * math.log(10) - scale
            options.append((best[start][0] + value, -start))
        value, start = max(options)
        best.append((value, -start))
    out, end = [], len(label)
    while end:
        start = best[end][1]
        out.append(label[start:end])
        end = start
    return out[::-1]


def scaled(words: DataFrame, total: int) -> DataFrame:
    """``word, n``: counts as they would be in ``TOTAL`` words, so that a cut doesn't depend on the corpus' size."""
    known = words.where(F.col("n") >= max(LEAST_COUNT, LEAST_SHARE * total)).select("word", (F.col("n") * (TOTAL / max(total, 1))).alias("n"))
    unwanted = words.sparkSession.createDataFrame([(w, UNWANTED_SHARE * TOTAL) for w in UNWANTED], "word string, n double")
    return known.unionByName(unwanted).groupBy("word").agg(F.sum("n").alias("n"))


def cut_labels(labels: DataFrame, words: DataFrame) -> DataFrame:
    """``label, words`` for the distinct values of ``labels.label``.

    Labels have at most ``LONGEST_LABEL`` characters of interest (the limit of
    the domain name system); longer ones are cut in pieces of that length.
    """
    # one number for the whole corpus
    total = int(words.agg(F.sum("n")).first()[0] or 0)
    seeded = scaled(words, total)
    distinct = labels.select("label").distinct()
    spans = distinct.select(
        "label",
        F.explode(F.sequence(F.lit(1), F.greatest(F.length("label"), F.lit(1)))).alias("i"),
    ).select("label", F.explode(F.transform(F.sequence(F.lit(1), F.lit(LONGEST_WORD)), lambda n: F.substring(F.col("label"), F.col("i"), n))).alias("word"))
    known = (
        spans.distinct()
        .join(seeded, "word")
        .groupBy("label")
        .agg(F.collect_list(F.struct("word", "n")).alias("known"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = {k["word"]: k["n"] for k in known or ()}
                pieces = [label[i : i + LONGEST_LABEL] for i in range(0, len(label), LONGEST_LABEL)]
                out.append([w for p in pieces for w in cut(p, counts, TOTAL)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["label", "words"])

    return distinct.join(known, "label", "left").select("label", "known").mapInArrow(run, "label string, words array<string>")


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, host_words, block_odds`` for every page.

    ``block_odds`` is the log odds of the method (null where the host is empty).
    """
    url = F.col(f"`{url_col}`")
    verdicts = {rule_name(r): r[2] for r in rules}
    # the words are summed and joined: the pages are read for them once
    words = materialize(page_words(pages.select(F.col(f"`{html_col}`").alias("html"))), "page-words")
    rows = materialize(
        pages.select(F.col(f"`{id_col}`").alias("page_id"), F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path")),
        "urls",
    )
    hosts = rows.where("host <> ''").select("host").distinct()
    # labels of letters and digits of any script
    parts = hosts.select("host", F.posexplode(F.filter(F.split("host", r"[^\p{L}\p{N}]+"), lambda x: x != "")).alias("at", "label"))
    cut_up = cut_labels(parts, words)
    hosts_cut = materialize(
        parts.join(cut_up, "label")
        .groupBy("host")
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("host_words")),
        "hosts",
    )
    # training examples are all urls; equal (host, path tokens) rows count through n
    path_tokens = F.filter(F.split(F.lower("path"), r"[^a-z]+"), lambda x: x != "")
    shapes = materialize(
        rows.where("host <> ''")
        .select("host", path_tokens.alias("path_tokens"))
        .groupBy("host", "path_tokens")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(hosts_cut, "host", "left")
        .withColumn("host_words", F.coalesce("host_words", F.array().cast("array<string>")))
        .withColumn("bad", F.arrays_overlap("host_words", F.array(*[F.lit(w) for w in SURE])))
        .withColumn("tokens", F.concat(F.transform("host_words", lambda w: F.concat(F.lit("h:"), w)), F.transform("path_tokens", lambda w: F.concat(F.lit("p:"), w)))),
        "shapes",
    )
    each = shapes.select("bad", "n", F.explode("tokens").alias("token"))
    tokens = each.groupBy("token").agg(
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad_n"),
        F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("good_n"),
    )
    sums = tokens.agg(F.sum("bad_n"), F.sum("good_n"), F.count(F.lit(1))).first()
    urls = shapes.agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)), F.sum("n")).first()
    bad_all, good_all, size = (float(x or 0) for x in sums)
    bad_urls, all_urls = (float(x or 0) for x in urls)
    odds = tokens.select(
        "token",
        (
            F.log((F.col("bad_n") + PRIOR) / F.lit(bad_all + PRIOR * max(size, 1)))
            - F.log((F.col("good_n") + PRIOR) / F.lit(good_all + PRIOR * max(size, 1)))
        ).alias("odds"),
    )
    prior = math.log((bad_urls + 1) / (all_urls - bad_urls + 1))
    scored = (
        shapes.select("host", "path_tokens", F.explode_outer("tokens").alias("token"))
        .join(odds, "token", "left")
        .groupBy("host", "path_tokens")
        .agg(F.coalesce(F.sum(F.round("odds", 9).cast("decimal(28,9)")).cast("double"), F.lit(0.0)).alias("odds"))
        .select("host", "path_tokens", (F.col("odds") + F.lit(prior)).alias("block_odds"))
    )
    judged = (
        rows.withColumn("path_tokens", path_tokens)
        .join(scored, ["host", "path_tokens"], "left")
        .join(hosts_cut, "host", "left")
        .withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    )
    by_method = F.when(F.col("block_odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    by_rule = F.lit(None).cast("string")
    for name, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == name, F.lit(verdict)).otherwise(by_rule)
    return judged.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_method).alias("verdict"), "host_words", "block_odds")
