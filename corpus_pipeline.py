"""A training corpus out of ``documents``, stage by stage.

Every stage takes all that the one before kept and returns the columns of
documents; the last one returns what it reads back from the token files.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spinneret.llm import decontaminate, mixing, simhash, token_files, toxicity
from spinneret.llm.queries import tokenizer_path
from spinneret.operators.scratch import scratch_path

#: Learnt models and hash signatures are beyond SQL.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learnt from their labels does not find toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash fingerprints of three-word shingles that
    differ in at most three bits."""
    return simhash.one_of_each(docs, shingle=3, bits=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of source, language and topic."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, number of ids and checksum of every document in the token files."""
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, path, tokenizer_path())
    return token_files.read_token_files(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
