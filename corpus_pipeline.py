"""A corpus made ready for training: toxic documents and near copies go, repeated passages are
cut out, contaminated documents go, and what is left is encoded."""

from __future__ import annotations

import public_tokenizers
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import bpe_codec, decontaminate, ngram_join, substring_dedup, toxicity
from tallyforge.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (a score under 0.5); all of them where no
    labelled text is there to train on."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), in_task=True)
    if not model.trained:
        return docs
    return toxicity.score(docs, model, prefix="tf_").where("tf_predicted = 0").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) the row with the smallest id (null last),
    and one of rows that repeat it; rows without words stay."""
    return ngram_join.one_of_each(docs)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one holds; n_chars follows the text."""
    found = substring_dedup.deduplicated(docs, prefix="tf_")
    size = F.when(F.col("tf_n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", size).select(*docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows are less than a twentieth."""
    marked = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"), prefix="tf_")
    return marked.where("not tf_contaminated").select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the text decoded from them."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_codec.digests(bpe_codec.encode(docs, path, keep=["doc_id"]), path)


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_join", without_copies),
    ("substring_dedup", without_passages),
    ("decontaminate", without_benchmarks),
    ("byte_bpe", encoded),
]

#: A trained classifier and content-defined paragraphs are beyond SQL: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
