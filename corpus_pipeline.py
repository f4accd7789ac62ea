"""The corpus pipeline: documents through the stages below, each written and read again.

Quality rules and near-dedup keep or drop documents, exact dedup keeps one of equal texts,
mixing puts the rest in order, and the last stage gives their SentencePiece ids with their
position in that order.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow.llm import exact_dedup, mixing, near_dedup, pieces, quality
from newsflow.llm.common import session_of, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside their language's band go."""
    return quality.good_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the one with the largest doc_id."""
    return exact_dedup.without_copies(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id.

    Near copies share 80 percent of their shingles of five words.
    """
    return near_dedup.without_near_copies(docs, words=5, similarity=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mix, with their position in it."""
    return mixing.in_mixed_order(docs, position="position")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, position in the mix, n_ids, ids, and the digest of the text that the ids
    decode to."""
    return pieces.encode(docs, keep=("position",)).select(
        "doc_id",
        "position",
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

# Language-model scores, minhash tables and piece lattices are beyond SQL; the tests
# compare the pipeline with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    session_of(docs)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
