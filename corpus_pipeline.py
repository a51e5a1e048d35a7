"""A corpus from raw documents to tokens, by five of the training-data operators.

Each stage is (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and read again
as the next one's docs. All but the last return the columns of documents, also when there are more
of them or named as operators' own. Rows with null or empty texts pass every stage that their score
passes; equal rows are near-duplicates of each other; very long texts are read whole; of an empty
table nothing comes out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import tokenize
from tidemark.llm.common import remove, shared_dir, table
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.neardup import keep_firsts
from tidemark.llm.pii import redact
from tidemark.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on `labels`, scores 0.3 or more."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: that of the least doc_id."""
    return keep_firsts(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind, and n_chars, where there is one, counted anew."""
    out = redact(docs)
    if "n_chars" not in docs.columns:
        return out
    n = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return out.withColumn("n_chars", n)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and decoded text of each row."""
    import public_tokenizers

    return tokenize(docs, public_tokenizers.path("word_bpe_49k.json"), keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("tokens", tokens),
]
#: Models and hashed draws can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. A stage's table goes when the next one's is written; the last
    table stays, as the result reads it."""
    docs, before = table(spark, sf_dir, "documents"), None
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
        if before:
            remove(spark, before)
        before = f"{at}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
