"""The corpus pipeline: documents in, packed training sequences out. Each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstack.llm import exact_dedup, langid, minhash, packing, secrets
from loamstack.llm.queries import new_index, tokenizer_path
from loamstack.llm.store import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the language model rejects: no letters, or too far from every centroid."""
    return langid.drop_rejected(docs, langid.LanguageModel.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each normalised text."""
    return exact_dedup.drop_copies(docs, new_index(spark))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    return minhash.drop_near_duplicates(docs)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; all documents stay."""
    done = secrets.redact(docs, secrets.MarkovRatio.fit(secrets.default_samples(docs)))
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' pieces into sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), ids=False)


STAGES = [("language ID", language_id), ("exact dedup", exact_copies), ("MinHash near-dedup", near_copies), ("secret scans", secret_spans), ("best-fit packing", packed)]
#: The Markov models and the packing can't be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
