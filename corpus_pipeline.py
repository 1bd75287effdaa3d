"""Training-corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All stages but
the last return the columns of documents.  Extra columns are kept up to packing,
whatever their names; an empty table gives an empty table with the same columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import best_two_fit, prob_minhash, quality_gam, secret_forest, simhash_leaks
from contrail.llm.queries import read, train_rows, vocabulary
from contrail.llm.shipping import ship
from contrail.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts.  A null text is judged as the empty
    text, texts of any length as a whole; equal texts are judged alike, so repeated rows
    all stay or all go.  Without labels every row stays."""
    model = quality_gam.fit(docs, train_rows(read(spark, sf_dir, "labels")))
    return docs.where(quality_gam.score_column(F.col("text"), model) >= 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the smallest doc_id (a null
    one only if the class has no other; of several texts with that id the one of the
    smallest hash).  Repeated rows become one; rows with a null text all stay; equal
    texts without a word are one class."""
    ship(spark)
    return prob_minhash.dedup(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark passage.  Rows with a null or empty text stay, repeated
    rows fare alike; null and empty items are found nowhere, an item of 1 to 4 words
    only as a document of exactly these words; an empty benchmark keeps all."""
    return simhash_leaks.clean(spark, docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, as often as they occur; secrets are replaced in the text, whatever its
    length, and n_chars follows.  Null and empty texts stay as they are."""
    ship(spark)
    return secret_forest.redact(docs, secret_forest.fit(spark, docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 1024.  A null or empty text is the end id
    alone; longer documents are cut into pieces; repeated rows and ids are packed as often
    as they occur."""
    ship(spark)
    return best_two_fit.pack(spark, docs, vocabulary("byte_bpe_50k.json"), 2)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", packing)]

#: Trained models and tokenizers have no SQL form; tests hold each stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/contrail-work/{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
