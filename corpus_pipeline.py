"""From raw documents to encoded training text: quality, toxicity, near copies, mixing, BPE.

Every stage takes the documents that its predecessor kept and returns documents
with the same columns; the last returns token ids. Stages are written to the
shared folder as Parquet and read again, so each starts from settled rows.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.llm import bpe, forest, mixing, quality, toxicity
from tallymark.llm.queries import held_out
from tallymark.llm.registry import ship_package, table
from tallymark.sources.scratch import stash


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the language references are counted from this stage's documents."""
    ship_package(spark)
    judged = quality.judge(docs, quality.learn_references(docs))
    return judged.filter(col("kept")).select(*[col(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic, by a model of the labelled ones among them."""
    ship_package(spark)
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id", 5, 0))
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.filter(col("predicted") == 0).select(*[col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of at least 0.8 hold together: the one with the least id."""
    ship_package(spark)
    return forest.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document once for each epoch that takes from it, whole. A source exceeds its target by less than
    one document; documents that the mix does not reach go."""
    mixed = mixing.mix(docs, mixing.word_count(col("text")))
    epochs = F.when(col("taken") > 0, F.ceil(col("taken") / col("size"))).otherwise(F.lit(0)).cast("int")
    repeated = mixed.withColumn("_epoch", F.explode(F.array_repeat(F.lit(1), epochs)))
    return repeated.select(*[col(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, packed as little-endian unsigned 32-bit integers, with the digest of what they decode to."""
    ship_package(spark)
    encoded = bpe.encode_decode(docs.select("doc_id", "source", "lang", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id", "source", "lang", "n_tokens", "token_ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    return reduce(
        lambda docs, stage: stash(stage[1](spark, docs, sf_dir), "pipeline"), STAGES, table(spark, sf_dir, "documents")
    )
