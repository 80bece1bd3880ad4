"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import line_quality, mixing, ngram_join, packing, personal_data
from sightline.session import materialise

ORACLE_SQL = None  # models, permutations and token ids are beyond SQL; the tests hold the stages against brute force


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a quality score of at least 0.3; a null text scores like an empty one."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").filter(~line_quality.held_out()).select(
        "doc_id", F.col("quality").alias("label"))
    model = line_quality.train(docs, labels)
    return line_quality.score(docs, model).filter("score >= 0.3").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by Jaccard of at least 0.8 over five-word shingles."""
    return ngram_join.one_of_each(docs, n=5, percent=80)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by their kind."""
    return personal_data.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's share of words: a row for every time round that takes words of a document."""
    return mixing.Mix(docs).texts


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into sequences of at most 1024 tokens; one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("personal data", personal),
    ("source mixing", mix), ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
