"""Decontamination against sets of word tuples."""

import random
import re

from edge_cases import SF_DIR, prose, tally, texts

from brooklet.llm import decontamination
from brooklet.llm.queries import op9_decontamination


def grams(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def sequences(text):
    """All sequences of up to five words."""
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {tuple(words[i : i + n]) for n in range(1, 6) for i in range(len(words) - n + 1)}


def brute_force(docs, items):
    of_doc = {}
    for doc_id, text in docs:
        if doc_id is not None:
            of_doc.setdefault(doc_id, set()).update(sequences(text))
    out = set()
    for item_id, text in items:
        g = grams(text)
        for doc_id, found in of_doc.items():
            n = len(g & found)
            if item_id is not None and g and 100 * n >= 75 * len(g):
                out.add((doc_id, item_id, len(g), n, round(n / len(g), 9)))
    return sorted(out, key=repr)


def found(rows):
    return sorted(((*r[:4], round(r[4], 9)) for r in map(tuple, rows.collect())), key=repr)


def edge_items(docs):
    rng = random.Random(4)
    of = dict(docs)
    long = of[10].split()
    rows = [(1, of[2**60]), (2, " ".join(long[900:950])), (3, "one two"), (4, None), (5, ""), (None, of[2**60])]
    changed = list(long[2000:2060])
    changed[7] = "other"
    rows += [(6, " ".join(changed).upper()), (7, prose(rng, 30)), (8, "THE same, long; line here!"), (1, of[2**60])]
    changed[30], changed[50] = "x", "y"
    rows += [(9, " ".join(changed)), (10, " ".join(long)), (11, "…!"), (12, " ".join(long[100:106])), (13, of[14])]
    return [(*row, "k", 1) for row in rows]


def test_edge_rows(spark, edge):
    items = spark.createDataFrame(edge_items(texts(edge)), "item_id bigint, text string, gram string, n int")
    wanted = brute_force(texts(edge), [r[:2] for r in edge_items(texts(edge))])
    assert len({item for _, item, *_ in wanted}) >= 8
    assert found(decontamination.leaks(edge, items)) == wanted
    kept = decontamination.clean(edge, items)
    assert kept.columns == edge.columns
    leaked = {d for d, *_ in wanted}
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(
        repr(d) for d, _ in texts(edge) if d not in leaked
    )


def test_without_broadcast(spark, edge, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_HASHES", 0)
    test_edge_rows(spark, edge)


def test_documents(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert found(op9_decontamination(spark, SF_DIR)) == brute_force(texts(documents), items) != []


def test_partly_copied_items(spark):
    """Around the threshold, for items of all sizes."""
    rng = random.Random(12)
    items, docs = [], []
    for i in range(120):
        words = [f"w{rng.randrange(10**5)}" for _ in range(rng.choice([5, 6, 9, 12, 20, 33, 64, 130]))]
        items.append((i, " ".join(words)))
        for part in range(3):
            at = rng.randrange(max(1, len(words) // 3))
            piece = words[at:] if part else words[: len(words) - at]
            filler = [f"f{rng.randrange(10**5)}" for _ in range(rng.choice([0, 50, 2000]))]
            docs.append((3 * i + part, " ".join(filler + piece + filler[:7])))
    leaks = decontamination.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert found(leaks) == brute_force(docs, items)


def test_short_items_inside_long_documents(spark):
    rng = random.Random(3)
    items = [(1, "forty two"), (2, "Paris"), (3, "yes; of course"), (4, "one two three four"), (5, "two one"), (6, "never there")]
    filler = lambda n: " ".join(f"f{rng.randrange(10**5)}" for _ in range(n))
    docs = [
        (1, f"{filler(3000)} forty-two {filler(500)}"), (2, f"PARIS {filler(2)}"), (3, "yes of"), (4, "yes, of course!"),
        (5, f"{filler(9)} one two three four five"), (6, "one two three"), (7, f"{filler(7)} forty {filler(1)} two"), (8, "two"),
        (9, "paris"), (9, "of yes of"), (9, "course"), (None, "paris"), (10, None),
    ]
    leaks = decontamination.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    wanted = brute_force(docs, items)
    assert {(d, i) for d, i, *_ in wanted} == {(1, 1), (2, 2), (4, 3), (5, 4), (9, 2)}
    assert found(leaks) == wanted


def test_empty_tables(spark, edge, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "the river and the stone of light")], "item_id bigint, text string")
    assert decontamination.leaks(edge, none).count() == decontamination.leaks(empty, some).count() == 0
    assert decontamination.clean(edge, none).count() == edge.count()
