"""A training-data pipeline: each stage works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of documents; the last adds the ids. ``n_chars``
follows the text where a stage changes it. Stages handle nulls, empty texts, repeated rows and further columns
as their operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.llm import bpe, line_dedup, minhash, mixing, toxicity
from signalwatch.llm.common import col, fresh, stored, table
from signalwatch.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    ship_package(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    [score] = fresh(docs, "score")
    return toxicity.with_scores(docs, model, out=score).where(F.col(score) < toxicity.THRESHOLD).select(*map(col, docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the first of them."""
    ship_package(spark)
    rows = line_dedup.dedup_lines(docs)
    out = [F.length("text").cast("long").alias(c) if c == "n_chars" else col(c) for c in docs.columns]
    return rows.select(*out)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship_package(spark)
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    ship_package(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and the number of ids."""
    ship_package(spark)
    rows = bpe.with_ids(docs, public_tokenizers.path("word_bpe_49k.json"))
    [count] = fresh(rows, "n_tokens")
    return rows.withColumn(count, F.size(rows.columns[-1]).cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs


#: Drawn copies and a learnt classifier are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
