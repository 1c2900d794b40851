"""The queries opN_<name>: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.llm import ann, bpe, convtrie, html, langid, lm, minhash, mixing, sharding, suffixdedup, tokencount, topk, variants
from paysignal.llm.scratch import Scratch

VOCABULARY = "byte_bpe_50k.tiktoken"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), words=4, least=(80, 100)).drop("tid")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("rec.text"), F.lit(""))
    return sharding.shuffle_shards(docs, shards=16).select(
        F.col("rec.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op5_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lm.score(docs, held_out=langid.remainder(F.col("doc_id"), 7) == 2)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return tokencount.token_counts(
        read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select(
        F.col("rec.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(read(spark, sf_dir, "pages"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held_out = langid.remainder(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffixdedup.remove_repeats(docs, Scratch(spark, "repeats"), length=400)
    gone = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda n, x: n + x)
    return found.select(
        F.col("rec.doc_id").alias("doc_id"),
        (F.octet_length("kept") + gone).alias("n_bytes"),
        gone.alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.vocabulary(read(spark, sf_dir, "documents"))
    return variants.variants(words, Scratch(spark, "variants"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "convtrie")
    rebuilt = convtrie.grafted(convtrie.turns(read(spark, sf_dir, "conversations"), scratch), family=5, heads=9)
    return convtrie.prefix_trie(rebuilt, scratch, together=F.col("conv_id") - F.col("conv_id") % 5)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_topk": op1_topk,
        "op2_near_duplicates": op2_near_duplicates,
        "op3_neighbours": op3_neighbours,
        "op4_shards": op4_shards,
        "op5_score": op5_score,
        "op6_token_counts": op6_token_counts,
        "op7_bpe": op7_bpe,
        "op8_mix": op8_mix,
        "op9_main_text": op9_main_text,
        "op10_langid": op10_langid,
        "op11_repeats": op11_repeats,
        "op12_spelling": op12_spelling,
        "op13_prefix_trie": op13_prefix_trie,
    }
