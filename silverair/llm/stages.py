"""Stages of the corpus pipeline: (spark, docs, folder of tables) to the documents that go on."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverair.llm import quality_rules as rules
from silverair.llm import decontamination, sentencepiece_codec, simhash, suffix_dedup
from silverair.llm.fitting import fold
from silverair.llm.queries import PIECES
from silverair.operators.lookup import lookup_join
from silverair.session import configure

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the quality rules. The model learns from labelled rows of ``documents``."""
    configure(spark)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(fold("doc_id", 5) != 0)
    judged = rules.apply_rules(docs, rules.fit_rules(docs, labels), carry=COLUMNS)
    return judged.where("kept").select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each component: that with the smallest id, null ids last, those of one id by a digest of the row.

    Components are those of the 3-bit rule of the operator's contract, which misses most
    pairs of a five-word Jaccard near 0.8 (figures in the README). Documents that no link
    joins all stay, also where they share an id or have none.
    """
    configure(spark)
    return simhash.first_of_each(docs, columns=COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Packed ids and decoded text of every document."""
    configure(spark)
    return sentencepiece_codec.encode_decode(docs, public_tokenizers.path(PIECES))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document without the strings that an earlier one has; none is dropped.

    A range that begins or ends inside a character leaves that character whole.
    """
    configure(spark)
    return suffix_dedup.without_repeats(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that share no window with an item of ``benchmark``.

    Rows are told apart by a digest of all their columns, not by id, so a leak goes
    whatever its id, and no other text goes with it.
    """
    configure(spark)
    marked = docs.select(*COLUMNS).withColumn("row_digest", F.sha2(F.to_json(F.struct(*COLUMNS), {"ignoreNullFields": "false"}), 256))
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontamination.leaks(marked, benchmark, id_column="row_digest").select("row_digest").distinct()
    # Broadcast if it is measured to be small, else joined by salted digests.
    leaked = lookup_join(marked, found.withColumn("leaked", F.lit(True)), ["row_digest"], ["row_digest"], "left")
    return leaked.where(F.col("leaked").isNull()).select(*COLUMNS)
