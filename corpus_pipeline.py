"""From raw documents to training tokens, in four stages.

``run`` applies the stages to ``documents``; each stage's result is written as
Parquet to the cluster's shared folder and read again as the next one's input,
so a lost executor never costs more than a part of one stage. All stages but
the last return the columns of ``documents``. Executors and their Python workers
exchange texts in batches of bounded bytes (``bound_batches``).

1. language: documents that language identification rejects go (no letters, or
   margins too narrow to tell); ``lang`` becomes the predicted language.
2. near_duplicates: of each group of near-duplicates (five-word shingles,
   similarity 0.8) the document with the smallest id stays. Rows that repeat an
   id and text are one document; rows without an id stay.
3. mix: sources are mixed to their target weights; a document is repeated as
   often as the mix takes it, and goes if it takes it not at all.
4. tokens: byte-level BPE ids of every text, and the sha256 of the decoded ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.llm import bpe, langid, minhash, mixing
from paysignal.llm.scratch import Scratch
from paysignal.session import bound_batches

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = "byte_bpe_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    model = langid.fit(docs.filter(langid.remainder(F.col("doc_id"), 4) != 2))
    found = langid.predict(docs, model, carry=COLUMNS).filter(~F.col("rejected"))
    return found.select(*[F.col("lang_pred" if c == "lang" else c).alias(c) for c in COLUMNS])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    found = minhash.near_duplicates(docs, words=5, least=(80, 100))
    # a row goes by its id and its text: another text of the same id is another document
    gone = found.filter("NOT kept").select("doc_id", F.col("tid").alias("_tid")).distinct()
    left = docs.select(*COLUMNS, minhash.text_id("text").alias("_tid")).join(gone, ["doc_id", "_tid"], "left_anti")
    repeated = left.groupBy("doc_id", "_tid").count().filter("count > 1 AND doc_id IS NOT NULL").drop("count")
    if not repeated.isEmpty():
        once = left.join(repeated, ["doc_id", "_tid"], "left_semi").dropDuplicates(["doc_id", "_tid"])
        left = left.join(repeated, ["doc_id", "_tid"], "left_anti").unionByName(once)
    return left.select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = mixing.mix(docs.select(*COLUMNS)).filter("copies > 0")
    return found.select("rec.*", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return bpe.encode(
        docs,
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        carry=("doc_id", "lang", "source"),
        outputs=("n_tokens", "ids_sha256", "decoded_sha256", "ids"),
    )


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("mix", mix), ("tokens", tokens)]

#: SQL has no compression, minwise trees or BPE; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
