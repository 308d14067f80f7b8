"""The corpus pipeline: each stage works on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and reread as the next stage's docs.  All but the last return the columns of
documents; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontaminate, ngram_join, packing, pii, quality
from quire.llm._store import materialize, release, small_batches, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, n=5, num=80, den=100)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that holds any window of the benchmark goes, however long it is."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitised(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("pii", sanitise),
    ("best_fit_packing", pack),
]

#: Training a classifier and greedy packing are beyond SQL; tests hold the stages
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = _table(spark, sf_dir, "documents"), written()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        release(mark, docs)  # what the stage and those before it wrote is not read again
    return STAGES[-1][1](spark, docs, sf_dir)
