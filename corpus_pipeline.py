"""The training-data pipeline over documents: toxic texts go, then exact duplicates, then near
duplicates, and what is left is packed into sequences of tokens.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame;
all but the last return the columns of ``docs``. Rows with a null or empty text pass through as
empty texts, of which one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import few_at_once, remove, scratch
from tidemill.llm.harmonic_packing import packed_words
from tidemill.llm.pivot_simhash import one_of_each
from tidemill.llm.streaming_dedup import without_duplicates
from tidemill.llm.subsequence_svm import THRESHOLD, fitted, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold; the machine learns from the labels that ``docs`` has rows for."""
    model = fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    few_at_once(spark)
    name = "__toxicity"
    while name in docs.columns:
        name += "_"
    return toxicity(docs, model, name=name).where(F.col(name) < THRESHOLD).drop(name)


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return without_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates (two bits, or five-word shingles of a Jaccard similarity of 0.8), the row with the smallest doc_id."""
    return one_of_each(docs, words=5, similar=0.8)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document."""
    few_at_once(spark)
    return packed_words(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_duplicates),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack),
]

#: The stages learn, hash by XXH64 and encode by BPE, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written as Parquet in the shared folder and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(path := scratch(spark, name))
        docs = spark.read.schema(docs.schema).parquet(path)
        if before:
            remove(spark, before)  # the next stage's rows are written: nothing reads these any more
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
