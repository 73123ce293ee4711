"""The corpus pipeline: five stages over the table of documents, each an operator of ledgerspark.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import decontaminate, langid, mixing, near, sharding
from ledgerspark.llm.names import unused
from ledgerspark.llm.queries import table
from ledgerspark.sources.staging import Staging, scope


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages: those whose language is `und` (no letter, or no text) go.

    The decision travels as (doc_id, fingerprint of the text) of the rejected, which are few, so texts are shuffled only
    where these don't fit a broadcast.
    """
    rejected = langid.score(docs, langid.train(docs), keep_text_hash=True).where(F.col("lang_pred") == langid.UNKNOWN)
    key, print_ = unused(docs, "rejected_id", "rejected_print")
    bad = rejected.select(F.col("doc_id").alias(key), F.col("text_hash").alias(print_)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(print_))
    return docs.join(bad, same, "left_anti")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id."""
    return near.distinct(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark text overlaps."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every use of every document: no source is used less than once, scarce ones repeat up to the target weights."""
    # columns of docs keep their values, also those named like one that the operator adds
    (name,) = unused(docs, "document")
    rows = docs.select("doc_id", "source", mixing.tokens(docs["text"]).alias("n_tokens"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name))
    return mixing.mix(rows, text=False).select(f"{name}.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and slot for every use of a document."""
    return sharding.shard(docs)


STAGES = [
    ("language", language),
    ("deduplicate", deduplicated),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("shard", sharded),
]

#: Language ID is trained, components and the mixing exponent are iterated; SQL has no such steps.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage has written for itself is deleted once its own result is written."""
    stage = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        with scope():
            docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
