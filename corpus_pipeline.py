"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and gives the documents that the next one works on, the last one the
packed pieces. Every decision takes effect: what a stage rejects or cuts is gone for those after it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.llm import mixing, packing, substring_dedup, text_dedup, toxicity
from tallyroom.llm.frames import settle

#: The smallest source is passed over at most so often, the largest once: no document is lost in mixing.
REPETITION_LIMIT = 2.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not take for toxic; null and empty texts stay."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id. Documents without words or id stay;
    rows that share an id are told apart by their texts, see `text_dedup.one_of_each`."""
    return text_dedup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more stay where they first stand. All rows stay, with n_chars counted anew."""
    cut = substring_dedup.remove_repeats(docs, 13)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least; those of small sources again, as rows of their own."""
    mixed = mixing.mix_sources(docs, target_entropy=0.98, repetition_limit=REPETITION_LIMIT)
    return mixed.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", keep_one_of_each),
    ("substring_dedup", cut_repeats),
    ("mixing", mix),
    ("packing", pack),
]

#: No SQL expresses a trained classifier; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents of `sf_dir` that pass the stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
