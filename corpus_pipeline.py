"""The corpus pipeline: from raw documents to token ids.

Toxic documents go, one document of each class of near-duplicates stays, documents with
benchmark passages go, sources are mixed to their target weights, and the token ids of
the mix are written to files and read back. Each stage sees all that its predecessor
kept, as a Parquet table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.llm import decontam, mixing, neardup, tokenio, toxicity
from assayframe.llm.query_tools import table
from assayframe.llm.scratch import remainder, stored
from assayframe.runtime import scratch_path


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold, with the columns of ``docs``."""
    labels = table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id")) != 2)
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class, with the columns of ``docs``."""
    return neardup.drop_near_duplicates(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark, with the columns of ``docs``."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with the columns of ``docs``."""
    return mixing.repeated(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each row, read back from the files."""
    return tokenio.through_files(docs, scratch_path(spark, "token-ids"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: SQL can express neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
