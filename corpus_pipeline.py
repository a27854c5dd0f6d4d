"""Training-data pipeline over ``documents``: quality, near duplicates,
repeated passages, benchmark leaks, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  Each stage's result is written as Parquet and read again
as the next one's ``docs``.  All but the last return the columns of
``documents``; texts and columns beyond these pass through unchanged where a
stage doesn't say otherwise.  Null and empty texts pass every stage unless the
classifier rejects them; empty tables give empty results; rows equal in id and
text stay repeated until the near-duplicate stage, which keeps one.  Different
texts under one id, and rows without an id, are documents of their own.
"""

from __future__ import annotations

import os
import sys
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ticksmith.llm import bpe, decontaminate, jaccard, quality, substring_dedup  # noqa: E402
from ticksmith.llm.queries import table, train_quality, vocabulary_path  # noqa: E402
from ticksmith.plans.storage import scratch_path  # noqa: E402


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the line CRF rejects go."""
    model = train_quality(spark, sf_dir, docs)
    return quality.score(docs, model).where("predicted = 1").select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9, five-word shingles at similarity 0.8: of each group the row of smallest doc_id stays."""
    return jaccard.one_of_each_group(docs, k=5, threshold=Fraction(8, 10))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: words of 35-word windows that start at a second place go; n_chars follows the text."""
    found = substring_dedup.dedup_substrings(docs, with_text=True)
    text = F.when(F.col("row.text").isNull(), F.lit(None).cast("string")).otherwise(F.col("kept_text"))
    return found.select("row.*", text.alias("_kept")).withColumns(
        {"text": F.col("_kept"), "n_chars": F.when(F.col("_kept") == F.col("text"), F.col("n_chars"))
         .otherwise(F.length("_kept").cast("long"))}).drop("_kept")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark window go."""
    return (decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
            .where("NOT contaminated").select("row.*"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: ids of every text; the digest of the decoded bytes shows the round trip."""
    return bpe.encode_documents(docs, vocabulary_path()).select(
        F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each_group),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: SQL can't express the trained classifier; tests/llm/test_pipeline.py compares each stage with
#: plain Python on its own input (the classifier's decisions with its scores, held out in test_operators).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
