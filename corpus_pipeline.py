"""A training-data pipeline: five stages, each written as Parquet and reread.

``STAGES`` lists (name, function).  A function takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of ``docs``.

1. ``quality``: documents that the positive-unlabelled classifier scores below 0.7 go.
2. ``lines``: later copies of line runs of 50 words or more are deleted; a document
   that loses every line goes.
3. ``simhash``: one document of each component of near-equal fingerprints stays.
4. ``decontaminate``: documents that hold ten consecutive words of a benchmark item go.
5. ``mix``: all that is left, in the order of the target weights, with its slot.

Nulls, empty texts, ties, repeated rows, empty tables and clashing columns are
handled as the operators' docstrings say.  ``ORACLE_SQL`` is None: SQL cannot
express the classifier; the tests hold ``run`` against a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanpulse.llm import decontaminate, lines, mixing, quality, simhash
from urbanpulse.llm.common import shared_folder, table


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the classifier accepts; it is fitted on these documents and the given labels."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete repeated line runs to their last line; ``n_chars`` follows the text."""
    found = lines.dedup_lines(docs, min_words=50, whole_runs=True)
    gone = lines.n_removed()
    kept = found.where((gone == 0) | (gone < F.col("n_lines")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(gone > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of each component: 3-word shingles, 3 bits."""
    return simhash.keep_one(docs, shingle=3, seed=42, max_bits=3)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a hit of a 10-word benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), n=10)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Order by the schedule of the production weights."""
    return mixing.mix(docs)


STAGES = [("quality", stage_quality), ("lines", stage_lines), ("simhash", stage_simhash),
          ("decontaminate", stage_decontaminate), ("mix", stage_mix)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
