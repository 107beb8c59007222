"""From documents to packed sequences: each stage works on all that its predecessor kept.

A stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import decontaminate, jaccard_join, lang_id, packing, toxicity
from tidemart.llm.common import table
from tidemart.llm.queries import word_tokenizer
from tidemart.session import Scratch


#: rows that go to a Python worker at a time. Texts are long: the default of 10,000 is tens of megabytes,
#: which the JVM and the worker hold several times over.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"


def small_batches(stage):
    """A stage in a session that was left at the default gets smaller batches; a chosen size stays."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_ROWS[0]) == "10000":
            spark.conf.set(*BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those rejected go."""
    return lang_id.keep_identified(docs)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the similarity join links."""
    return jaccard_join.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    # fewer words remembered than in a job of its own: workers have served four stages by then
    return packing.pack(docs, packing.PackParams(word_tokenizer(), remembered=250_000))


STAGES = [
    ("language_id", small_batches(identified)),
    ("toxicity", small_batches(civil)),
    ("ngram_jaccard_join", small_batches(distinct)),
    ("benchmark_decontamination", small_batches(uncontaminated)),
    ("best_fit_packing", small_batches(packed)),
]

#: models and a tokenizer take part, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
