"""A corpus from documents to packed sequences; each stage is one operator of ``brooklet.llm``.

A null text is an empty one throughout; an empty table leads to no piece. Repeated rows and
very long texts are what the operators of the stages make of them. Python tasks get texts a
few megabytes at a time, which the stages set in the session. A document that loses
all its lines to line dedup stays, as an empty text, and is packed as a lone end id: the
stages' order is given, and each keeps the documents it does not reject.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from brooklet.llm.common import columns, read_table, small_batches, written
from brooklet.plans.inputs import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def lean(stage: Stage) -> Stage:
    """``stage`` with batches that bound the memory of executors and of their Python workers."""

    @wraps(stage)
    def run_lean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_lean


@lean
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under the threshold."""
    machine = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, machine)


@lean
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a smaller one holds; n_chars as it then is."""
    index = line_dedup.LineIndex(spark, scratch(spark, "lines"))
    index.insert(docs)
    kept = index.kept(docs).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*columns(docs))


@lean
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates."""
    return ngram_join.deduplicated(docs)


@lean
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


@lean
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' tokens and their places in the sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

# A learned score and token ids are beyond SQL: tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what a stage returns is written and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
