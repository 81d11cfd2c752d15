"""Packing: every id in one place, sequences without gaps, little padding, ids of the library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from edge_cases import SF_DIR, prose, texts
from tokenizers import Tokenizer

from brooklet.llm import byte_bpe, packing
from brooklet.llm.queries import op8_packing

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def check(rows, texts, library, capacity=1024):
    """``rows``: of pack_documents with ids. Documents are told apart by their ids."""
    wanted = sorted((str(d), [*library.encode(t, add_special_tokens=False).ids, 0]) for d, t in texts)
    made, places = {}, {}
    for r in rows:
        assert 0 < r.length == len(r.ids) <= capacity
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        made.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, r.ids))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    rebuilt = []
    for (doc_id, n), parts in made.items():
        copies = sum(start == 0 for start, _ in parts)
        parts.sort()
        for turn in range(copies):
            ids = [x for _, part in parts[turn::copies] for x in part]
            assert len(ids) == n
            rebuilt.append((doc_id, ids))
    assert sorted(rebuilt) == wanted
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return [sum(length for _, length in parts) for parts in places.values()]


def test_edge_rows(edge, library):
    check(packing.pack_documents(edge.dropDuplicates(["doc_id", "text"]), TOKENIZER).collect(), _distinct(edge), library)


def _distinct(rows):
    return texts(rows.dropDuplicates(["doc_id", "text"]))


def test_repeated_rows_are_documents_of_their_own(edge):
    pieces = packing.pack_documents(edge, TOKENIZER, with_ids=False)
    assert pieces.filter("start = 0").count() == edge.count()


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_small_windows(spark, library, capacity):
    rng = random.Random(capacity)
    rows = [(i, prose(rng, rng.randrange(30))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(packing.pack_documents(docs, TOKENIZER, capacity).collect(), rows, library, capacity)


def test_documents(spark, documents, library):
    rows = packing.pack_documents(documents, TOKENIZER).persist()
    filled = check(rows.collect(), texts(documents), library)
    padding = sum(1024 - n for n in filled if n & (n - 1))
    assert padding < 0.01 * sum(filled) + 1024
    assert tuple(packing.padding(rows).first()) == (len(filled), sum(filled), padding)
    assert op8_packing(spark, SF_DIR).count() == rows.count()


def test_empty_table(empty):
    assert packing.pack_documents(empty, TOKENIZER).count() == 0


def test_best_fit_decreasing():
    """Against a search of all open sequences."""
    rng = random.Random(1)
    for capacity in (1, 5, 16, 100):
        lengths = [rng.randint(1, capacity) for _ in range(300)]
        sequence, offset = packing.best_fit_decreasing(lengths, capacity)
        room, wanted = [], {}
        for i in sorted(range(300), key=lambda i: -lengths[i]):
            fitting = [r for r in room if r >= lengths[i]]
            wanted[i] = min(fitting, default=capacity)
            if fitting:
                room.remove(min(fitting))
            room.append(wanted[i] - lengths[i])
        assert [capacity - o for o in offset] == [wanted[i] for i in range(300)]
        assert len(set(sequence)) == len(room)


def test_texts_are_encoded_as_the_library_encodes_them(library):
    rng = random.Random(9)
    pieces = ["a", "The", "don't", "é", "漢字", "12", "3a", "...", "<|endoftext|>", "$", "we'll"]
    gaps = [" ", " ", " ", " ", "\n", "  ", " \n", "\n ", "\n\n", "\t", " ", "\u0085", " 　", "\x1c", ""]
    made = ["".join(rng.choice(pieces) + rng.choice(gaps) for _ in range(rng.randrange(12))) for _ in range(3000)]
    made += [" " + m for m in made[:200]] + ["\n" + m for m in made[:200]]
    encoder = byte_bpe.Encoder(TOKENIZER)
    for at in range(0, len(made), 500):
        part = made[at : at + 500]
        wanted = [x.ids for x in library.encode_batch(part, add_special_tokens=False)]
        assert [list(encoder.ids(text)) for text in part] == wanted
