"""A corpus from raw documents to token ids: five stages, each on all that the one before it kept.

Defined results, stage by stage: a null text is an empty one for every stage and stays null where it is kept; a text without words is
never toxic, never a near duplicate and never contaminated, so it stays; rows without a doc_id are judged by their texts, after all
others; repeated rows are near duplicates of each other, and one of them stays; texts of any length are read whole; an empty
table gives none, and without labels of both kinds no document is toxic.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from brimline.llm import decontamination, jaccard, pieces, pii, toxicity
from brimline.sources.writers import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where(F.col("score") < toxicity.THRESHOLD).drop("score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return jaccard.unique_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty stands in a passage of the benchmark."""
    return decontamination.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    found = pii.find_spans(docs).withColumn("text", F.col("redacted"))
    return found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding them gives its text back."""
    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "same")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("sentencepiece", encode),
]

#: The first stage fits a model, so SQL cannot say which rows come out; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
