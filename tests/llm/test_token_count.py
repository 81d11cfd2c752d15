"""Token counts against the library on whole texts, with small chunks too."""

import random

import public_tokenizers
import pytest
import sentencepiece
from edge_cases import SF_DIR, prose, tally, texts

from brooklet.llm import token_count
from brooklet.llm.queries import op7_token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def brute_force(library, rows):
    return sorted(((d, len(t.encode()), len(library.encode(t))) for d, t in rows), key=repr)


@pytest.mark.parametrize(("chunk", "overlap"), [(token_count.CHUNK, token_count.OVERLAP), (64, 4), (40, 1), (1000, 16)])
def test_edge_rows(edge, library, chunk, overlap):
    rows = edge.filter("doc_id IS NULL OR doc_id <> 12") if chunk < 64 else edge
    assert tally(token_count.count_tokens(rows, MODEL, chunk, overlap)) == brute_force(library, texts(rows))


def test_hard_to_cut_texts(spark, library):
    rng = random.Random(2)
    rows = [
        "x" * 5000, "漢字" * 3000, "a b " * 2000, "  " * 3000, ("word" + " " * 50) * 100, "▁" * 1000 + " ▁a▁ b" * 300,
        "\n" * 4000, prose(rng, 3000), "é" * 999 + " " + "😀" * 2000, " " + prose(rng, 500) + " ",
    ]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    for chunk, overlap in ((100, 8), (977, 64)):
        assert tally(token_count.count_tokens(docs, MODEL, chunk, overlap)) == brute_force(library, enumerate(rows))


def test_documents(spark, documents, library):
    rows = tally(op7_token_counts(spark, SF_DIR))
    assert [r[:3] for r in rows] == brute_force(library, texts(documents))
    assert all(r[3] == (r[2] > 4096) for r in rows)


def test_empty_table(empty):
    assert token_count.count_tokens(empty, MODEL).count() == 0


def test_the_vocabulary_allows_splices():
    assert token_count.splices(MODEL)


def test_a_splice_is_the_same_from_both_sides(library):
    text = "the quick brown fox jumps over the lazy dog " * 20
    whole = token_count.chunk_tokens(library, text, True, len(text), 0)
    left = token_count.chunk_tokens(library, text[:420], True, 400, 20)
    right = token_count.chunk_tokens(library, text[400:], False, len(text), 20)
    assert left + right == whole == len(library.encode(text))
