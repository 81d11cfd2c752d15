"""The registered queries of the operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm import (
    bin_completion,
    collocations,
    decontamination,
    license_scan,
    line_dedup,
    lm_scoring,
    ngram_join,
    oracle,
    packing,
    spotsigs,
    token_count,
    toxicity,
    warc,
    whitening,
)
from brooklet.llm.common import read_table, remainder
from brooklet.plans.inputs import scratch

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In two batches, a part of the second taken out and put in again: the decisions are those of one."""
    docs = read_table(spark, sf_dir, "documents")
    index = line_dedup.LineIndex(spark, scratch(spark, "lines"))
    index.insert(docs.filter(remainder(2) == 0))
    index.insert(docs.filter(remainder(2) == 1))
    again = docs.filter(remainder(32) == 1)
    index.delete(again)
    index.insert(again)
    kept = index.kept(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = remainder(3) == 1
    machine = toxicity.train(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, machine).withColumn("held_out", held_out)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.Archive(spark, scratch(spark, "warc")).write(read_table(spark, sf_dir, "pages"))
    read = archive.read_all()
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = spotsigs.edits(read_table(spark, sf_dir, "documents"))
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.fingerprint("signatures").alias("fingerprint"),
        spotsigs.fingerprint("edited_signatures").alias("edited_fingerprint"),
        spotsigs.likeness("signatures", "edited_signatures").alias("near_edited"),
        spotsigs.likeness("signatures", "next_signatures").alias("near_next"),
    )


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tokenizer = public_tokenizers.path("piece_bpe_32k.model")
    scores = lm_scoring.score_texts(docs, remainder(7) != 2, tokenizer)
    return scores.withColumn("held_out", remainder(7) == 2)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.leaks(docs, items)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of a tree: source, language, thousand, document."""
    docs = read_table(spark, sf_dir, "documents")
    parts = ["source", "lang", F.floor(F.col("doc_id") / 1000), F.col("doc_id")]
    files = docs.select(F.concat_ws("/", *(p if isinstance(p, str) else p.cast("string") for p in parts)).alias("path"), "text")
    found = license_scan.scan(files)
    doc_id = F.element_at(F.split("path", "/"), -1).cast("bigint")
    return found.select(doc_id.alias("doc_id"), "path", "license", "similarity", "found", "directory")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    counts = token_count.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, tokenizer, with_ids=False)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    model = whitening.fit(rows)
    found = whitening.components(whitening.transform(rows, model), model)
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return bin_completion.pack_documents(docs, tokenizer, with_ids=False)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_warc": op3_warc,
    "op4_spotsigs": op4_spotsigs,
    "op5_ngram_join": op5_ngram_join,
    "op6_license_scan": op6_license_scan,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_decontamination": op9_decontamination,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_whitening": op11_whitening,
    "op12_bin_completion": op12_bin_completion,
    "op13_collocations": op13_collocations,
}

#: The others' results are beyond SQL: tests compare them with brute force.
SQL: dict[str, str] = {
    "op1_line_dedup": oracle.LINE_DEDUP,
    "op5_ngram_join": oracle.NGRAM_JOIN,
    "op9_decontamination": oracle.DECONTAMINATION,
    "op13_collocations": oracle.COLLOCATIONS,
}
