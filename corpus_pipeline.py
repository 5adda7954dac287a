"""A corpus from raw documents to tokens: five stages, each a job over all that its predecessor kept.

Every stage takes and returns whole documents (all columns of ``documents``), written to the shared folder in between, so a
lost executor costs no more than its part of one stage. Null, empty and repeated rows are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.llm import decontaminate, jaccard_join, pieces, suffix_dedup, toxicity
from lendframe.llm.queries import table, tokenizer
from lendframe.staging import release, staging_path, temporary

#: No SQL expresses the language models and the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models do not reject. They learn from the labelled documents among ``docs``."""
    return toxicity.ordinary_only(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that link by 5-word shingles at 0.75 the one with the smallest id."""
    return jaccard_join.one_of_each(docs, size=5, percent=75)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that also start earlier; ``n_chars``, if there, counts what is left."""
    cut = suffix_dedup.without_repeats(docs, length=100)
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    return decontaminate.remove_affected(docs, table(spark, sf_dir, "benchmark"), window=10)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece numbers of every text that is left, and whether they decode to it."""
    return pieces.encode(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    root = staging_path(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        with temporary():
            stage(spark, docs, sf_dir).write.parquet(path)
        release(spark)
        docs = spark.read.parquet(path)
    return docs
