"""The registered queries of the dealt operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from avionyx.llm import (
    bpe,
    language,
    latent,
    mixing,
    near_dups,
    prefix_trie,
    quality,
    ranking,
    sharding,
    substrings,
    toxicity,
    url_filter,
    warc,
)

TOKENIZER = "word_bpe_49k.json"

# (host, path, verdict)
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language.fold(F.col("doc_id"), 3) == 1
    model = language.fit(docs.where(~held_out))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = quality.quality_ledger(docs)
    bits = F.col("fail_bits")
    return ledger.select(
        "doc_id",
        *[f"ledger.{m}" for m in quality.MEASURES],
        "fail_bits",
        (~quality.passes(bits, "base")).alias("base_failed"),
        quality.passes(bits).alias("kept"),
    )


def op1_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_collinear_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


def op5_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = language.fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80).drop("text_hash")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    heads = language.fold(F.col("conv_id"), 4)
    return prefix_trie.prefix_nodes(prefix_trie.with_shared_heads(convs, 20, heads, 3))


def op12_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most_epochs=3)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_normalise": op1_warc_normalise,
    "op2_latent_decontamination": op2_latent_decontamination,
    "op3_bpe_chunk_reuse": op3_bpe_chunk_reuse,
    "op4_collinear_substrings": op4_collinear_substrings,
    "op5_toxicity_grammar": op5_toxicity_grammar,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_sharding": op8_sharding,
    "op9_language_id": op9_language_id,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_weighted_mix": op12_weighted_mix,
    "op13_ranked_search": op13_ranked_search,
}
