"""A training-data pipeline over the table documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import exact_dedup, jaccard_join, packing, secret_scan, toxicity
from tallyforge.llm.queries import TOXIC, tokenizer_file, toxicity_model
from tallyforge.llm.scratch import reach_package, store, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    reach_package(spark)
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir), TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a class of texts that share four fifths of their five-word shingles the smallest doc_id stays."""
    return jaccard_join.keep_one_of_each(docs, jaccard_join.similarity_classes(docs, size=5, num=80, den=100))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; n_chars follows."""
    found = max(docs.columns, key=len) + "_found"  # no column of docs has this name
    scanned = secret_scan.scan_secrets(docs).withColumn(found, F.size("spans") > 0)
    cleaned = secret_scan.redact(scanned)
    n_chars = F.when(F.col(found), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", n_chars).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of 2,048 ids."""
    reach_package(spark)
    return packing.pack_documents(docs, tokenizer_file(), size=2048, end=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", redact_secrets),
    ("packing", pack),
]

ORACLE_SQL = None  # a classifier, a metric join and a tokenizer: tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again, so a lost executor costs one stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
