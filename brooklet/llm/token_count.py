"""Token counts, with huge documents encoded in overlapping chunks.

A document of up to ``chunk`` characters is encoded whole. A longer one is cut into
chunks that overlap; every chunk is a row of its own, so that no task holds a whole
huge document's encoding. Two neighbours are spliced at a position of their overlap
that is *stable*, found in both encodings as the start of a token. Why such a position
is safe: no entry of the vocabulary has a word mark after another character, so no
merge can ever join what stands left and right of a space that follows a non-space.
Tokens left of it do not depend on the text to its right, nor the other way round. The
vocabulary is tested for that property; for one without it documents are encoded whole.

Where an overlap has no such position, or one encoding does not have it, the document
is tried again with a wider overlap; at last one chunk spans it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import named_text, slices, written

CHUNK = 32_768
OVERLAP = 256
WIDEN = 16
MARK = "▁"
SPACES = " " + MARK


@cache
def processor(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model)


@cache
def splices(model: str) -> bool:
    """Whether a space after a non-space is a boundary of every encoding."""
    sp = processor(model)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    return not any(MARK in piece.lstrip(MARK) for piece in pieces)


def stable_position(overlap: str) -> int | None:
    """The first place in ``overlap`` where a space follows a non-space."""
    for at in range(1, len(overlap)):
        if overlap[at] in SPACES and overlap[at - 1] not in SPACES:
            return at
    return None


def token_starts(sp: sentencepiece.SentencePieceProcessor, text: str) -> list[int]:
    """The byte of ``text`` at which each token begins."""
    return [piece.begin for piece in sp.encode(text, out_type="proto").pieces]


def chunk_tokens(
    sp: sentencepiece.SentencePieceProcessor, text: str, first: bool, step: int, overlap: int
) -> int | None:
    """Tokens of a chunk between its two splices; None where one of them fails.

    ``text`` holds ``step`` characters and then the overlap with the next chunk, if
    there is one; a chunk that is not the first begins with the overlap with the last.
    """
    starts = token_starts(sp, text)
    low, high = 0, len(starts)
    where = {at: i for i, at in reversed(list(enumerate(starts)))}
    splice = lambda begin: stable_position(text[begin : begin + overlap])
    token = lambda at: where.get(len(text[:at].encode()))
    if not first:
        at = splice(0)
        low = None if at is None else token(at)
    if len(text) > step:
        at = splice(step)
        high = None if at is None else token(step + at)
    return None if low is None or high is None else high - low


def _count_whole(model: str):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sp = processor(model)
        for batch in slices(batches):
            ids = sp.encode(batch["text"].tolist(), num_threads=1)
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": [len(x) for x in ids]}
            )

    return count


def _chunks(step: int, overlap: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                last = max(0, len(row.text) - overlap - 1) // step
                for i in range(last + 1):
                    end = len(row.text) if i == last else (i + 1) * step + overlap
                    piece = row.text[i * step : end]
                    yield pd.DataFrame(
                        [(row.doc_id, row.digest, i, piece, i == last)],
                        columns=["doc_id", "digest", "chunk", "text", "last"],
                    )

    return cut


def _count_chunks(model: str, step: int, overlap: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sp = processor(model)
        for batch in batches:
            n = [
                chunk_tokens(sp, r.text, r.chunk == 0, len(r.text) if r.last else step, overlap)
                for r in batch.itertuples(index=False)
            ]
            yield batch[["doc_id", "digest"]].assign(n_tokens=pd.array(n, dtype="Int64"))

    return count


def _long_counts(texts: DataFrame, model: str, chunk: int, overlap: int) -> DataFrame:
    """doc_id, digest, n_tokens of documents that are longer than a chunk."""
    longest = texts.agg(F.max(F.length("text"))).first()[0] or 0
    done = None
    while True:
        whole = overlap >= longest or not splices(model)
        step = max(longest, 1) if whole else chunk
        rows = texts.select("doc_id", "digest", "text")
        pieces = rows.mapInPandas(
            _chunks(step, 0 if whole else overlap),
            "doc_id string, digest string, chunk long, text string, last boolean",
        )
        spread = pieces.repartition(F.col("doc_id"), F.col("digest"), F.col("chunk"))
        counted = spread.mapInPandas(
            _count_chunks(model, step, overlap), "doc_id string, digest string, n_tokens long"
        )
        totals = counted.groupBy("doc_id", "digest").agg(
            F.sum("n_tokens").alias("n_tokens"), F.count_if(F.col("n_tokens").isNull()).alias("failed")
        )
        totals = written(totals, "token-totals")
        good = totals.filter("failed = 0").select("doc_id", "digest", "n_tokens")
        done = good if done is None else done.unionByName(good)
        bad = totals.filter("failed > 0")
        if whole or bad.isEmpty():
            return done
        failed = bad.select("doc_id", "digest")
        same = texts["doc_id"].eqNullSafe(failed["doc_id"]) & (texts["digest"] == failed["digest"])
        texts = texts.join(failed, same, "left_semi")
        overlap = min(overlap * WIDEN, longest)
        chunk = max(chunk, 2 * overlap)


def count_tokens(
    docs: DataFrame, model: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row of ``docs``.

    ``model`` is a sentencepiece file that every executor can open. Counts are those of
    the library for the whole text, without begin or end tokens. A null text counts as
    an empty one: 0 and 0. Repeated rows, also of a null doc_id, are each returned;
    other columns of ``docs`` are not looked at. An empty table gives an empty one.
    """
    rows = named_text(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    short, long = rows.filter(F.length("text") <= chunk), rows.filter(F.length("text") > chunk)
    schema = "doc_id string, n_bytes long, n_tokens long"
    counts = short.mapInPandas(_count_whole(model), schema)
    # Equal long rows are encoded once and given back as often as they occur.
    keyed = long.withColumn("digest", F.sha2("text", 256))
    texts = written(keyed.dropDuplicates(["doc_id", "digest"]), "long-texts")
    as_number = F.col("doc_id").cast("bigint")
    if texts.isEmpty():
        return counts.withColumn("doc_id", as_number)
    rows = keyed.select("doc_id", "n_bytes", "digest")
    totals = _long_counts(texts, model, chunk, overlap).withColumnRenamed("doc_id", "of")
    same = rows["doc_id"].eqNullSafe(totals["of"]) & (rows["digest"] == totals["digest"])
    all_rows = counts.unionByName(rows.join(totals, same).select("doc_id", "n_bytes", "n_tokens"))
    return all_rows.withColumn("doc_id", as_number)
