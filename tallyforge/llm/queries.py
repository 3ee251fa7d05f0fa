"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.embedding_dedup import near_duplicates
from tallyforge.llm.exact_dedup import exact_groups
from tallyforge.llm.jaccard_join import similarity_classes
from tallyforge.llm.packing import pack_documents
from tallyforge.llm.scratch import table
from tallyforge.llm.secret_scan import report, scan_secrets
from tallyforge.llm import conversation_repair, decontaminate, hard_negatives, html_extract, license_scan, piece_nbest, toxicity
from tallyforge.llm.token_files import read_checksums, write_token_files
from tallyforge.session import intermediate_path

BPE_FILE = "byte_bpe_50k.json"
TOXIC = 0.3  # a document with this score or more is called toxic


def tokenizer_file(name: str = BPE_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents"), size=3, num=90, den=100, links=True)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def op3_huffman_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = intermediate_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file(), end=0)
    return read_checksums(spark, path)


def op4_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_nbest.summary(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), n=4)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learned from the labels that are not held out."""
    return toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id"))))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(spark, docs, sf_dir)
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is the file source/lang/doc_id.txt."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.concat("doc_id", F.lit(".txt")))
    return license_scan.scan(docs.select("doc_id", "text", path.alias("path")), "doc_id", "path", "text")


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(), size=2048, end=1)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(scan_secrets(table(spark, sf_dir, "documents")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows).withColumnRenamed("id", "conv_id")


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_html_extraction": op2_html_extraction,
    "op3_huffman_token_files": op3_huffman_token_files,
    "op4_sentencepiece_nbest": op4_sentencepiece_nbest,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_license_scan": op8_license_scan,
    "op9_sum_of_squares_packing": op9_sum_of_squares_packing,
    "op10_secret_scan": op10_secret_scan,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_benchmark_decontamination": op12_benchmark_decontamination,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_benchmark_decontamination": decontaminate.oracle(),
    "op13_hard_negatives": hard_negatives.ORACLE,
    "op8_license_scan": license_scan.oracle("concat_ws('/', coalesce(source, ''), coalesce(lang, ''), doc_id || '.txt')"),
}
