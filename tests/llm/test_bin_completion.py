"""Bin completion: every id in one place, ids of the library, as few bins as an exhaustive search finds."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from edge_cases import SF_DIR, prose, texts
from tokenizers import Tokenizer

from brooklet.llm import bin_completion, byte_bpe
from brooklet.llm.queries import op12_bin_completion

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def check(rows, texts, library, capacity):
    """``rows``: of pack_documents with ids; documents are told apart by their ids. Returns what bins hold."""
    wanted = sorted((str(d), [*library.encode(t, add_special_tokens=False).ids, 0]) for d, t in texts)
    made, places = {}, {}
    for r in rows:
        assert 0 < r.length == len(r.ids) <= capacity
        assert r.length == capacity or r.piece == 0
        assert r.piece == math.ceil(r.start / capacity)
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
    rows = edge.dropDuplicates(["doc_id", "text"])
    for capacity in (2048, 50):
        check(bin_completion.pack_documents(rows, TOKENIZER, capacity).collect(), texts(rows), library, capacity)


def test_repeated_rows_are_documents_of_their_own(edge):
    pieces = bin_completion.pack_documents(edge, TOKENIZER, with_ids=False)
    assert pieces.filter("piece = 0").count() == edge.count()


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_small_windows_and_many_levels(spark, library, capacity):
    rng = random.Random(capacity)
    rows = [(i, prose(rng, rng.randrange(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    pieces = bin_completion.cut_pieces(docs, TOKENIZER, capacity).persist()
    whole = bin_completion.pack(pieces, capacity).collect()
    dealt = bin_completion.pack(pieces, capacity, group=24).collect()
    least = bin_completion.least_bins(np.bincount([r.length for r in whole], minlength=capacity + 1).tolist(), capacity)
    assert len(check(whole, rows, library, capacity)) <= least + 1
    assert len(check(dealt, rows, library, capacity)) <= least + 3


def test_query(spark, documents, library):
    rows = op12_bin_completion(spark, SF_DIR).persist()
    with_ids = bin_completion.pack_documents(documents, TOKENIZER)
    filled = check(with_ids.collect(), texts(documents), library, 2048)
    sequences, tokens, least = bin_completion.summary(rows).first()
    assert (sequences, tokens) == (len(filled), sum(filled))
    assert least <= sequences <= least + 1
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(rows.select(*key).collect()) == sorted(with_ids.select(*key).collect())


def test_empty_table(empty):
    assert bin_completion.pack_documents(empty, TOKENIZER).count() == 0


def fewest(lengths, capacity):
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {room: k for k, room in enumerate(rooms) if room >= lengths[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_fewest_bins():
    """Against an exhaustive search, also where best fit decreasing needs more."""
    rng, gained = random.Random(3), 0
    for _ in range(1500):
        capacity = rng.choice([7, 10, 20, 37, 64, 100])
        low = rng.choice([1, capacity // 5 + 1, capacity // 4])
        high = max(low, int(capacity * rng.choice([0.4, 0.6, 1])))
        lengths = [rng.randint(low, high) for _ in range(rng.randrange(13))]
        bins = bin_completion.Search(lengths, capacity).solve()
        assert sorted(n for b in bins for n in b) == sorted(lengths)
        assert all(sum(b) <= capacity for b in bins)
        wanted = fewest(lengths, capacity)
        assert len(bins) == wanted
        counts = np.bincount(np.array(lengths, int), minlength=capacity + 1).tolist()
        assert bin_completion.least_bins(counts, capacity) <= wanted
        gained += len(bin_completion.best_fit_decreasing(counts, capacity)) > wanted
    assert gained > 5


def test_fillings_are_undominated_and_complete():
    """Against all subsets: what is left out is dominated by a longer or shorter-numbered filling."""
    rng = random.Random(8)
    for _ in range(200):
        lengths = [rng.randint(1, 12) for _ in range(rng.randrange(1, 8))]
        room = rng.randint(1, 20)
        search = bin_completion.Search(lengths, 32)
        found = {tuple(f) for f in search.fillings(room, room, [10**6])}
        subsets = set()
        for bits in range(1 << len(lengths)):
            subset = tuple(sorted((n for i, n in enumerate(lengths) if bits >> i & 1), reverse=True))
            if sum(subset) <= room:
                subsets.add(subset)
        kept = set()
        for subset in subsets:
            rest = list(lengths)
            for n in subset:
                rest.remove(n)
            slack = room - sum(subset)
            parts = [[n for i, n in enumerate(subset) if bits >> i & 1] for bits in range(1 << len(subset))]
            worse = any(
                sum(p) <= x <= sum(p) + slack and (len(p) != 1 or x > p[0]) for p in parts for x in rest
            )
            if not worse:
                kept.add(subset)
        if room in lengths:
            assert found == {(room,)}
        else:
            assert found == kept


def test_a_known_packing_is_kept_unless_a_better_one_is_found():
    known = [[6, 4], [5, 5], [7, 3]]
    assert bin_completion.Search([6, 4, 5, 5, 7, 3], 10).solve(known) == known
    assert len(bin_completion.Search([6, 4, 5, 5], 10).solve([[6], [4, 5], [5]])) == 2


def test_out_of_steps_best_fit_remains():
    rng = random.Random(1)
    lengths = [rng.randint(200, 700) for _ in range(300)]
    counts = np.bincount(lengths, minlength=1001).tolist()
    few = bin_completion.Search(lengths, 1000, nodes=0).solve()
    assert len(few) == len(bin_completion.best_fit_decreasing(counts, 1000))
    assert len(bin_completion.Search(lengths, 1000).solve()) <= len(few)


def test_ids_are_those_of_the_library(library):
    rng = random.Random(9)
    pieces = ["a", "The", "don't", "é", "漢字", "12", "3a", "...", "<|endoftext|>", "$", "we'll", "\U0001f600", "\x00", "ß́"]
    gaps = [" ", " ", " ", "\n", "  ", " \n", "\n ", "\n\n", "\t", "\u0085", " 　", "\x1c", ""]
    made = ["".join(rng.choice(pieces) + rng.choice(gaps) for _ in range(rng.randrange(12))) for _ in range(3000)]
    letters = [chr(c) for c in range(0x3000) if not chr(c).isspace()]
    made += ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    made += ["x1y" * 30_000, " " * 50_000, "\n" * 9_999, "ab" * 40_000, "é" * 20_000]
    encoder = byte_bpe.Encoder(TOKENIZER)
    assert encoder.ranked
    wanted = [x.ids for x in library.encode_batch(made, add_special_tokens=False)]
    assert [encoder.ids(t).tolist() for t in made] == wanted


def test_other_vocabularies_go_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = byte_bpe.Encoder(path)
    assert not encoder.ranked
    assert encoder.ids("Some words").tolist() == Tokenizer.from_file(path).encode("Some words", add_special_tokens=False).ids
