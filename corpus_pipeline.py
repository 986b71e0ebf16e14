"""From raw documents to mixed, encoded training data in five stages.

Every stage takes (spark, docs, sf_dir), works on all that the one before it kept and
returns a DataFrame that is written as Parquet and read again for the next one. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corvina.llm.common import checkpoint_dir
from corvina.llm.decontaminate import decontaminate
from corvina.llm.mixing import repeat
from corvina.llm.near_dedup import keep_one
from corvina.llm.token_store import byte_bpe, encode_and_read
from corvina.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity is below 0.7; the model learns from the labelled ones among them."""
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at similarity 0.8; blank documents stay."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any run of 10 words of a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, none to two times."""
    return repeat(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of all documents in wavelet-matrix files; per document where they are, how many, their CRC."""
    return encode_and_read(docs, tokenizer=byte_bpe())


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("token_output", token_output)]

#: Learned scores, hashed rounding and token ids have no SQL; tests hold the operators against brute force, plain sums or the library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{checkpoint_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
