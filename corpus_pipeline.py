"""A corpus from raw documents to packed training sequences, in four stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as
the next stage's docs; all but the last return the columns of ``documents``. Empty tables pass
through every stage. Null and textless documents leave at the first stage; repeated rows of one id stay together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedlens.llm import byte_cnn, lsh_forest, packing, pii
from feedlens.llm.common import fresh_folder, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: texts without a letter go, and those of at least 128 characters that the network finds in another language than their label
    with a score of at least 0.7 (``byte_cnn.accepted``'s parameters); missing labels are filled in.

    Where no row can teach the network (no labels at all, say), every text with a letter stays as it is.
    """
    return byte_cnn.accepted(docs, byte_cnn.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each group of near-duplicates the document with the smallest id stays; rows with a null id stay."""
    found = lsh_forest.near_duplicates(docs)
    dropped = found.where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: personal data is masked in the texts; every document stays."""
    return pii.redact(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the documents' tokens in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packing", pack)]

#: The stages' models and tokenizers can't be stated in SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; results between stages are Parquet tables in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
