"""The n-gram join against all pairs, on edge rows, documents and groups of near copies."""

import itertools
import random
import re

import numpy as np
import pytest
from edge_cases import SF_DIR, lower, prose, tally, texts

from brooklet.llm import ngram_join, set_join
from brooklet.llm.common import BATCH_BYTES, BYTES_SETTING
from brooklet.llm.components import components
from brooklet.llm.queries import op5_ngram_join


def gram_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def brute_force(rows):
    sets = [gram_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and None not in (rows[i][0], rows[j][0]):
            shared = len(sets[i] & sets[j])
            if 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    out = [(d, len(s), None if d is None else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]
    return sorted(out, key=repr)


def found(rows):
    return tally(rows.select("doc_id", "n_shingles", "component_id"))


def test_edge_rows(edge):
    assert found(ngram_join.near_duplicates(edge)) == brute_force(texts(edge))


def test_documents(spark, documents):
    assert found(op5_ngram_join(spark, SF_DIR)) == brute_force(texts(documents))


def near_copies():
    """Groups around the threshold, a passage that all share, and chains of small edits."""
    rng = random.Random(11)
    rows, passage = [], prose(rng, 40)
    for _ in range(3):
        base = prose(rng, 120).split(" ")
        for _ in range(30):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            rows.append(" ".join(words))
    chain = prose(rng, 100).split(" ")
    for _ in range(25):
        chain = list(chain)
        chain[rng.randrange(len(chain))] = f"c{rng.randrange(10**6)}"
        rows.append(" ".join(chain))
    rows += [passage + " " + prose(rng, rng.choice([4, 8, 12, 60, 200])) for _ in range(40)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("listed", "a_row", "rounds"), [(16, 8, 6), (2, 0.01, 6), (3, 0.5, 1), (2, 0.01, 0), (10**6, 8, 6)])
def test_groups_of_near_copies(spark, monkeypatch, listed, a_row, rounds):
    """Whichever way the pairs of a group are come by, the components are the same."""
    monkeypatch.setattr(set_join, "LISTED", listed)
    monkeypatch.setattr(set_join, "PAIRS_A_ROW", a_row)
    monkeypatch.setattr(set_join, "HUB_ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "LEAST_FREQUENCY", 3)
    docs = spark.createDataFrame(near_copies(), "doc_id bigint, text string")
    assert found(ngram_join.near_duplicates(docs)) == brute_force(near_copies())


def test_one_document_of_each_group_stays(edge, empty):
    kept = ngram_join.deduplicated(edge)
    assert kept.columns == edge.columns
    named = {d for d, _, c in brute_force(texts(edge)) if d is not None and d == c}
    rows = kept.collect()
    assert {r.doc_id for r in rows if r.doc_id is not None} == named
    assert sum(r.doc_id is None for r in rows) == edge.filter("doc_id IS NULL").count()
    assert ngram_join.deduplicated(empty).count() == ngram_join.near_duplicates(empty).count() == 0


def test_linked_sets_share_as_many_prefix_members_as_both_ask_for():
    rng = np.random.default_rng(4)
    for _ in range(300):
        shared = int(rng.integers(1, 80))
        own = int(rng.integers(0, max(1, shared // 3)))
        a = set(rng.choice(10**6, shared + own, replace=False).tolist())
        b = set(list(a)[:shared]) | set(rng.choice(10**6, rng.integers(0, 9), replace=False).tolist())
        if 100 * len(a & b) < 75 * len(a | b):
            continue
        cost = {x: int(rng.integers(0, 50)) for x in a | b}
        prefixes = []
        for one in (a, b):
            order = sorted(one, key=lambda x: (cost[x], x))
            length, matches = ngram_join.choose_prefix(len(order), np.array([cost[x] for x in order]), 75)
            prefixes.append((set(order[:length]), matches))
        (x, k), (y, m) = prefixes
        assert len(x & y) >= min(k, m)


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1100)]
    edges += [(5000, 5000 + i) for i in range(200)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert dict(tuple(r) for r in rows.collect()) == {x: find(x) for x in list(root)}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_parities_never_part_linked_sets():
    """Bits that differ are at most the members that differ, and far sets differ in many."""
    rng = np.random.default_rng(9)
    pruned = far = 0
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 2**62, n)).astype(np.uint64)
        cut = int(n * rng.random() * 0.6)
        b = np.unique(np.concatenate([rng.permutation(a)[cut:], rng.integers(0, 2**62, cut).astype(np.uint64)]))
        words = zip(ngram_join.parity(a), ngram_join.parity(b), strict=True)
        apart = sum(((x ^ y) % 2**64).bit_count() for x, y in words)
        differ = len(np.setxor1d(a, b))
        assert apart <= differ
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 50 * (len(a) + len(b) - shared):
            far += 1
            least = (75 * (len(a) + len(b)) + 174) // 175
            pruned += apart > len(a) + len(b) - 2 * least
    assert pruned > 0.8 * far > 20


def test_every_link_is_found(spark):
    """In large groups too, where few of the links connect all that is linked."""
    rows = near_copies()
    sets = {frozenset(gram_set(text)) for _, text in rows}
    links = dict.fromkeys(sets, 0)
    for a, b in itertools.combinations(sets, 2):
        if 100 * len(a & b) >= 75 * len(a | b):
            links[a] += 1
            links[b] += 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.links for r in ngram_join.near_duplicates(docs).collect()}
    assert found == {doc_id: links[frozenset(gram_set(text))] for doc_id, text in rows}
    assert max(found.values()) > set_join.LISTED
    join = ngram_join.NgramJoin(docs)
    pairs = join.links()
    assert pairs.count() == pairs.select("a", "b").distinct().count() == sum(links.values()) // 2


@pytest.mark.parametrize(("listed", "a_row", "rounds"), [(16, 8, 6), (2, 0.01, 6), (3, 0.5, 1), (2, 0.01, 0)])
def test_links_that_connect(spark, monkeypatch, listed, a_row, rounds):
    """Whichever way the pairs of a group are come by, they connect what all links do."""
    monkeypatch.setattr(set_join, "LISTED", listed)
    monkeypatch.setattr(set_join, "PAIRS_A_ROW", a_row)
    monkeypatch.setattr(set_join, "HUB_ROUNDS", rounds)
    join = ngram_join.NgramJoin(spark.createDataFrame(near_copies(), "doc_id bigint, text string"))
    assert found(join.components(join.connecting())) == brute_force(near_copies())


@pytest.mark.parametrize(("members", "sets", "columns"), [(1 << 14, 256, 1 << 14), (700, 256, 100), (1 << 14, 7, 1 << 14)])
def test_links_are_counted_without_a_row_for_each(spark, monkeypatch, members, sets, columns):
    """However the components are dealt into blocks, and with a set there twice."""
    monkeypatch.setattr(set_join, "BLOCK_MEMBERS", members)
    monkeypatch.setattr(set_join, "BLOCK_SETS", sets)
    monkeypatch.setattr(set_join, "COLUMNS", columns)
    rows = near_copies()
    docs = spark.createDataFrame(rows + rows[:50], "doc_id bigint, text string")
    listed = ngram_join.NgramJoin(docs)
    links = listed.links()
    join = ngram_join.NgramJoin(docs)
    connecting = join.connecting().persist()
    counted = {r.key: r.links for r in join.degrees(join.roots(connecting)).collect()}
    wanted = {}
    for r in links.collect():
        for key in (r.a, r.b):
            wanted[key] = wanted.get(key, 0) + 1
    assert counted == wanted
    connecting.unpersist()


def test_no_step_of_near_duplicates_lists_all_links(spark, monkeypatch):
    """A group of 400 near copies, any two of them linked: rows grow with it, not with its square."""
    rng = random.Random(3)
    base, made = prose(rng, 150).split(" "), []
    docs = spark.createDataFrame([(i, " ".join([f"w{i}", *base])) for i in range(400)], "doc_id bigint, text string")
    verified = ngram_join.NgramJoin._verified
    monkeypatch.setattr(
        ngram_join.NgramJoin, "_verified", lambda self, pairs: made.append((out := verified(self, pairs)).count()) or out
    )
    assert {(r.component_id, r.links) for r in ngram_join.near_duplicates(docs).collect()} == {(0, 399)}
    assert sum(made) < 400 * 20


def test_texts_go_to_python_a_few_megabytes_at_a_time(spark):
    was = spark.conf.get(BYTES_SETTING)
    try:
        spark.conf.unset(BYTES_SETTING)
        docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id bigint, text string")
        assert {r.component_id for r in ngram_join.near_duplicates(docs).collect()} == {1}
        assert spark.conf.get(BYTES_SETTING) == f"{BATCH_BYTES}b"
    finally:
        spark.conf.set(BYTES_SETTING, was)


def test_prefix_rows_meet_their_tokens_in_three_joins(spark, monkeypatch):
    """The bounds of a token come with its number of sets, and the least matches with what several sets have."""
    names = []
    monkeypatch.setattr(set_join, "written", lambda rows, name: names.append(name) or rows.localCheckpoint())
    monkeypatch.setattr(ngram_join, "written", lambda rows, name: names.append(name) or rows.localCheckpoint())
    rng = random.Random(5)
    made = [prose(rng, 40) for _ in range(6)]
    docs = spark.createDataFrame([(i, f"{made[i % 6]} end{i}") for i in range(18)], "doc_id bigint, text string")
    join = ngram_join.NgramJoin(docs)
    names.clear()
    rows = join._prefix_rows()
    assert [name for name in names if name in ("shared", "least", "sizes", "bounds")] == ["shared", "least", "sizes"]
    bounds = {}
    for r in join.prefixes.collect():
        bounds.setdefault(r.token, []).append((r.n, r.matches, set_join.needed(r.n, 75) - r.matches))
    assert bounds
    for r in rows.collect():
        n, matches, left = zip(*bounds[r.token], strict=True)
        assert (r.of_token, r.n_least, r.matches_least, r.left_most) == (len(n), min(n), min(matches), max(left))
