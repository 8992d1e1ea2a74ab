"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

1. toxicity: documents whose score reaches the threshold go;
2. near-duplicates: one document of each class stays, that with the smallest ``doc_id``;
3. benchmark: documents that hold a test item go;
4. secrets: secrets are replaced by a mark in ``text``, ``n_chars`` follows; every document stays;
5. tokens: every remaining document with its token count and the digests of its ids and of the decoded text.

Rows are whole documents, pairs of rows even two, so every stage sets Arrow batches of ``BATCH_ROWS`` rows for its session:
a Python worker then holds a few megabytes of texts at a time instead of tens.

Stages 1 to 4 return the columns of ``documents``. SQL can express neither the trained model nor the sketches, so the
pipeline is tested against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from frameline.llm import bpe, decontaminate, omh, secrets, toxicity
from frameline.llm.common import keep, read
from frameline.llm.queries import TOKENIZER

ORACLE_SQL = None
BATCH_ROWS = 500


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return omh.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return decontaminate.without_benchmark(docs, read(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return secrets.redacted(docs)


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return bpe.encode_decode(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark),
    ("secrets", mask_secrets),
    ("tokens", count_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
