"""A training corpus from the documents table: drop toxic texts, keep one of each group of
near copies, replace personal data, mix the sources, and encode what is left.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemark.llm.bpe import encode
from lakemark.llm.common import stored, table
from lakemark.llm.mixing import mix
from lakemark.llm.ngram_join import one_of_each
from lakemark.llm.pii import replace_pii
from lakemark.llm.queries import graded_labels, tokenizer_path
from lakemark.llm.toxicity import REJECT_AT, fit_toxicity, score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity, fitted on the labelled ones, stays below the limit."""
    model = fit_toxicity(docs, graded_labels(spark, sf_dir))
    scored = score_toxicity(docs, model, name="severity_")
    return scored.filter(F.col("severity_") < REJECT_AT).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of similar five-word sets."""
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data; ``n_chars`` follows the new text."""
    rows = replace_pii(docs)
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that each source comes near its target of words."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every whole text."""
    rows = encode(docs, tokenizer_path(), decoded=None)
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: The first stage fits a model, which SQL can't express; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again as the next one's docs."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
