"""From raw documents to training shards, in five stages.

Every stage is a function of (spark, docs, sf_dir) to a DataFrame that is written and
read again before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import decontaminate, hilbert, languages, mixture, near_dedup
from tidelog.llm.graph import stored
from tidelog.llm.texts import reach_workers

#: Per cent of common shingles from which the corpus has one of two documents; op5_near_dedup has its own.
SIMILAR = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(work: Stage) -> Stage:
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return work(spark, docs, sf_dir)

    return run


@_stage
def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, each with a language: a null ``lang`` is predicted.

    A null text, or one without a letter, has no language and goes. Repeated rows stay;
    an empty table stays empty, as in all stages.
    """
    return languages.keep_known(docs)


@_stage
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id (null last).

    Of repeated rows one stays. Texts without words, null ones too, are in no group and stay.
    """
    return near_dedup.deduplicate(docs, SIMILAR)


@_stage
def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates, as they are; one without words stays.

    Null texts and ids stay; repeated rows are judged each. Without items nothing goes.
    """
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document as often as the mix takes it.

    A null source is one of its own. A document without words, or with a null text, is not taken.
    """
    return mixture.mix(docs)


@_stage
def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with size, checksum, place on the Hilbert curve, shard and slot.

    Columns of these names are replaced. Nulls are the lowest values; repeated rows have a slot each.
    """
    return hilbert.shard(docs)


STAGES = [
    ("language_id", known_languages),
    ("near_dedup", one_of_each),
    ("decontamination", without_benchmarks),
    ("source_mixture", mixed_sources),
    ("sharding", sharded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs if not number else stored(docs, name), sf_dir)
    return docs
